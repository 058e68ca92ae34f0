from __future__ import annotations

import pytest

LONG = " ".join(f"word{i % 9973}" for i in range(60_000))

# doc_id, text, lang, source, n_chars and columns whose names operators use themselves.
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, node string, bands int, a int, b int, hashes int, shard int, ids int, size int"


def documents(spark, rows):
    """A table of documents with clashing columns from (doc_id, text) or (doc_id, text, source)."""
    full = [
        (r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), "n", 1, 2, 3, 4, 5, 6, 7) for r in rows
    ]
    return spark.createDataFrame(full, COLUMNS)


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls, empty and white texts, a very long one, repeated rows and ids, ties."""
    return documents(
        spark,
        [
            (1, "Some plain words that make a text of more than ten words in all, as they should."),
            (1, "Some plain words that make a text of more than ten words in all, as they should."),
            (2, "Some plain words that make a text of more than ten words in all, as they should."),
            (3, None),
            (4, ""),
            (5, " \n\t "),
            (None, "A text without an id that has more than ten words so that rules let it pass."),
            (None, None, None),
            (6, LONG),
            (7, "one"),
            (7, "two"),
            (8, "Line of no host but more words than ten are here, one two three.\nagain\nagain", None),
        ],
    )


@pytest.fixture(scope="session")
def nothing(spark):
    return documents(spark, [])
