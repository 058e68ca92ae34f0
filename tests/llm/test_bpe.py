"""Byte-pair encoding and token trees against the tokenizers library and full recounts."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeloom.llm import bpe, token_counts
from lakeloom.llm.queries import cleaning_edits, vocabulary_path

PATH = vocabulary_path()
ODD = [
    "", " ", "  a", "a  b", "\n x \n\n y", "it's don't 'll x'd", "<|endoftext|>a<|endoftext|>", "<|endoftext|", "a" * 500,
    "é ü  　漢字123 ٣٤", "😀😀 ok", "\u0085x \x1c y\x1f", "x " * 300, "\t\t", "½²Ⅷ a", "​z", "\x00\x01", "ab" * 300 + "!" * 200,
]


@pytest.fixture(scope="module")
def codec():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Codec(file.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(codec, text):
    return np.frombuffer(codec.encode(text), "<i4").tolist()


@pytest.mark.parametrize("text", ODD)
def test_odd_texts_as_the_library(codec, library, text):
    expected = library.encode(text, add_special_tokens=False).ids
    assert ids(codec, text) == expected
    assert codec.decode(expected) == library.decode(expected, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(" \n\t ab'sé1½!漢<|>\u0085\x1cE"), max_size=60))
def test_any_text_as_the_library(text):
    own, library = _pair()
    assert ids(own, text) == library.encode(text, add_special_tokens=False).ids


_PAIR: list = []


def _pair():
    if not _PAIR:
        with open(PATH, encoding="utf-8") as file:
            _PAIR.extend([bpe.Codec(file.read()), Tokenizer.from_file(PATH)])
    return _PAIR


def test_long_and_short_merges_agree(codec):
    word = ("lowerthingsABC" * 4)[: bpe.LONG].encode()
    parts = [codec.single[b] for b in word]
    assert codec._merge_long(list(parts)) == codec.merge(word)


def test_many_words_are_merged_together(codec, monkeypatch):
    """Rows of one array give what one word after the other gives, whatever shares the array."""
    rng = random.Random(3)
    words = ["".join(rng.choice("etaoinsßé漢 \n!1") for _ in range(rng.randrange(0, 90))).encode() for _ in range(400)] + [b"\0", b"a\0", b"a" * 64, b"a" * 65]
    expected = [codec._packed(codec.merge(word)) for word in words]
    for size in (1, 7, 4_096):
        monkeypatch.setattr(bpe, "WORDS", size)
        assert codec.merge_all(words) == expected
    calls = []
    monkeypatch.setattr(codec, "merge", lambda word: calls.append(word) or [])
    codec.merge_all([word for word in words if len(word) <= bpe.LONG])
    assert not calls


def test_texts_together_as_one_by_one(library, monkeypatch):
    with open(PATH, encoding="utf-8") as file:
        own = bpe.Codec(file.read(), 10)
    rng = random.Random(4)
    texts = ODD + [" ".join(rng.choice(ODD + ["the", "things.", "a\nb", "Das"]) for _ in range(rng.randrange(8))) for _ in range(200)]
    for chars in (1, 300, 1_000_000):
        monkeypatch.setattr(bpe, "CHARS", chars)
        found = [np.frombuffer(e, "<i4").tolist() for e in own.encode_all(texts)]
        assert found == [library.encode(text, add_special_tokens=False).ids for text in texts]
        assert max(map(len, (own.spaced, own.first, own.pretokens))) <= 10
    assert own.encode_all([]) == []


def test_what_is_kept_is_bounded(codec, monkeypatch):
    for table in (codec.pretokens, codec.first, codec.spaced):
        table.clear()
        monkeypatch.setattr(table, "most", 10)
    words = " ".join(f"w{i}" for i in range(200))
    expected = ids(codec, words)
    assert len(codec.spaced) <= 10 and ids(codec, words) == expected


def test_table_as_the_library(spark, folder, library):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for row in bpe.encode(docs, PATH, decoded="decoded").collect():
        assert row["ids"] == library.encode(row["text"], add_special_tokens=False).ids
        assert row["decoded"] == row["text"]


def test_messy_rows(spark, messy, nothing, library):
    encoded = bpe.encode(messy, PATH, into="tokens", decoded="back")
    assert encoded.columns == [*messy.columns, "tokens", "back"]
    rows = encoded.collect()
    assert len(rows) == messy.count()
    for row in rows:
        assert row["tokens"] == library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["back"] == (row["text"] or "")
    again = bpe.decode(encoded, PATH, "tokens", "once_more")
    assert again.where("once_more != back").count() == 0
    assert bpe.encode(nothing, PATH, into="tokens").count() == 0


def edits_of(rng, text):
    found, at = [], 0
    for _ in range(rng.randint(0, 5)):
        start = rng.randint(at, len(text))
        at = rng.randint(start, min(len(text), start + 30))
        found.append({"start": start, "end": at, "new": rng.choice(["", " ", "x", "foo bar", "\n", "'s", "\n\n  "])})
    return found


def replaced(text, edits):
    for edit in reversed(edits):
        text = text[: edit["start"]] + edit["new"] + text[edit["end"] :]
    return text


def recount(codec, text):
    return sum(len(codec.merge(p.encode())) for p in codec.pattern.findall(text))


def test_trees_follow_edits(spark, folder, codec):
    rng = random.Random(7)
    texts = [r[0] for r in spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()]
    texts += ["".join(rng.choice(" \n\t ab'sé1!漢") for _ in range(rng.randint(0, 400))) for _ in range(300)]
    for text in texts:
        tree, edits = token_counts.Tree.of(codec, text), edits_of(rng, text)
        after = token_counts.edited(codec, tree, text, edits)
        assert after == replaced(text, edits)
        assert tree.count == recount(codec, after) and tree.chars[1] == len(after)
        for i in range(1, tree.leaves):
            assert tree.tokens[i] == tree.tokens[2 * i] + tree.tokens[2 * i + 1]


def test_an_edit_costs_its_surroundings(codec):
    text = "some words and more of them " * 5_000
    tree = token_counts.Tree.of(codec, text)
    token_counts.edited(codec, tree, text, [{"start": 70_000, "end": 70_010, "new": "changed"}])
    assert tree.encoded < 500


def test_edits_out_of_order_or_place_are_errors(codec):
    tree = token_counts.Tree.of(codec, "abc")
    with pytest.raises(ValueError):
        token_counts.edited(codec, tree, "abc", [{"start": 2, "end": 9, "new": ""}])
    with pytest.raises(ValueError):
        token_counts.edited(codec, tree, "abc", [{"start": 2, "end": 3, "new": ""}, {"start": 0, "end": 1, "new": ""}])


def test_messy_counts(spark, messy, nothing, codec):
    edits = F.udf(cleaning_edits, token_counts.EDITS, useArrow=True)
    counted = token_counts.count(messy, PATH).withColumn("edits", edits("text"))
    after = token_counts.apply_edits(counted, PATH)
    assert [c for c in after.columns if c in messy.columns] == messy.columns
    for row in after.collect():
        assert row["tree"]["tokens"][1] == recount(codec, row["text"] or "")
    no_edits = token_counts.count(messy, PATH).withColumn("edits", F.lit(None).cast(token_counts.EDITS))
    assert token_counts.apply_edits(no_edits, PATH).where("text is null").count() == messy.where("text is null").count()
    assert token_counts.count(nothing, PATH).count() == 0
    one_pass = token_counts.count_through_edits(messy, PATH, cleaning_edits, keep=["text"]).collect()
    in_steps = {r["text"]: r["tree"]["tokens"][1] for r in counted.select("text", "tree").collect()}
    afterwards = sorted(r["tree"]["tokens"][1] for r in after.collect())
    assert sorted(r["tokens"] for r in one_pass) == afterwards
    assert all(r["tokens_before"] == in_steps[r["text"]] for r in one_pass)
    assert token_counts.count_through_edits(nothing, PATH, cleaning_edits).count() == 0
