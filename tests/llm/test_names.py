"""Extra columns of the names that operators add: the added ones keep theirs, the others go on under a free name."""

from __future__ import annotations

from lakeloom.llm import bpe, decontaminate, html_extract, line_dedup, token_counts
from lakeloom.llm.common import beside
from lakeloom.llm.queries import vocabulary_path

WORDS = "a text of some words that is long enough to be found as an item of the benchmark"


def test_free_names():
    assert beside(["x", "Ids", "_ids"], ["ids"]) == ["x", "__Ids", "_ids"]
    assert beside(["x", "y"], []) == ["x", "y"] and beside([], ["ids"]) == []


def test_operators_make_room_for_what_they_add(spark):
    own = spark.createDataFrame([(1, WORDS, "h", 7, 8, 9)], "doc_id long, text string, source string, ids int, tokens int, edits int")
    row = bpe.encode(own, vocabulary_path()).first()
    assert row._ids == 7 and len(row.ids) > 5 and row.tokens == 8
    row = token_counts.count_through_edits(own, vocabulary_path(), lambda text: []).first()
    assert (row._tokens, row._edits, row.edits) == (8, 9, 0) and row.tokens == row.tokens_before > 5
    page = own.select("doc_id", "text", own.text.alias("html"))
    assert html_extract.extract(page).columns == ["doc_id", "_text", "html", "text"]
    assert html_extract.extract(page).first()._text == WORDS
    cleaned = line_dedup.drop_boilerplate(own, counters=("tokens", "edits")).first()
    assert (cleaned.text, cleaned._tokens, cleaned._edits, cleaned.tokens, cleaned.edits) == (WORDS, 8, 9, 1, 0)
    docs, items = (own.selectExpr(f"doc_id + {n} as item_id", "text") for n in (0, 1))
    assert decontaminate.matches(docs, items, id_column="item_id").select("_item_id", "item_id", "distance").first() == (1, 2, 0)
