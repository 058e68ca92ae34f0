"""Quality rules: counting rules, then a likelihood ratio of hashed n-grams.

Two multinomials over hashed word unigrams and bigrams are counted: one over a trusted target, one over
the raw corpus, each over all of its documents. A document's verdict is the mean log ratio of its n-grams
against a fixed threshold, so it neither depends on other documents' order nor on chance.

The wished number of buckets grows with the corpus, as ``BUCKETS_BY_ROOT`` times the cube root of its n-grams: 10^5 for
10 MB, 10^6 for 10 GB, 2 * 10^7 for 100 TB of text. So a mapper, which sums before anything is shuffled, ships no more
rows than there are buckets, and the ratios are one broadcast of bounded size (``BROADCAST_BUCKETS``; beyond it the
join is left to a shuffle). A ratio is a blend of those at the two powers of two around the wished number, by its place
between them, so it changes without a jump as the corpus grows. The coarse counts are sums of the fine ones.
Ratios are whole millionths, so sums do not depend on an order. A ratio depends on the text alone and comes back to its
rows by 128 bits of hash of the text.

Everything is DataFrame functions. Per document the work is linear in its words, but for texts with a
repeated window, whose windows are sorted.

Defined results: NULL and empty texts have no words, so they fail the base rules. An empty target gives
every n-gram the ratio 0, and the base rules decide alone. Repeated rows and repeated ids are judged row by
row. Extra columns are passed through, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import SPACE_CHARS, free_name, kept_rows, small_side, words, written

# The wished number of buckets for each unit of the cube root of the n-grams of the raw corpus.
BUCKETS_BY_ROOT = 512
# The largest table of ratios that is broadcast: 1 GB when hashed. 100 TB of text wish for half of it.
BROADCAST_BUCKETS = 1 << 25
# Ratios are whole numbers of this part of a nat.
UNIT = 1e-6
# Occurrences added to the seen and to the expected number in the target, so that rare n-grams say little.
PRIOR = 3.0
# Mean log ratio, in nats, below which a document reads unlike the target.
MIN_RATIO = -0.2
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5
SYMBOLS = "[#*$%&|<>]"

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


class Model(NamedTuple):
    ratios: DataFrame  # bucket, ratio in units, for each bucket with n-grams
    buckets: int


def _pairs(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: F.xxhash64(a, b))


def _from(array: Column, start: int) -> Column:
    return F.slice(array, start + 1, F.greatest(F.size(array), F.lit(1)))


def _upto(array: Column, fewer: int) -> Column:
    return F.slice(array, 1, F.greatest(F.size(array) - fewer, F.lit(0)))


def _hashed(df: DataFrame, text: str, names: dict[str, str]) -> DataFrame:
    """Add words, their hashes, and the hashes of neighbouring words."""
    hashes = F.col(names["hashes"])
    return (
        df.withColumn(names["words"], words(F.col(text)))
        .withColumn(names["hashes"], F.transform(names["words"], lambda w: F.xxhash64(w)))
        .withColumn(names["bigrams"], _pairs(_upto(hashes, 1), _from(hashes, 1)))
    )


def _bucket(hashed: Column, buckets: int) -> Column:
    if buckets & (buckets - 1):
        raise ValueError("the number of buckets must be a power of two")
    return hashed.bitwiseAND(F.lit(buckets - 1).cast("long"))


def _names(df: DataFrame) -> dict[str, str]:
    return {wish: free_name(df.columns, f"__{wish}") for wish in ("words", "hashes", "bigrams", "windows", "repeats")}


def wished_buckets(grams: int) -> float:
    return max(2.0, BUCKETS_BY_ROOT * grams ** (1 / 3))


def count_grams(df: DataFrame, text: str = "text") -> int:
    n = F.size(words(F.col(text))).cast("long")
    return df.agg(F.sum(n + F.greatest(n - 1, F.lit(0)))).first()[0] or 0


def bucket_counts(df: DataFrame, text: str = "text", trusted: str | None = None, buckets: int = 1 << 16) -> DataFrame:
    """(bucket, raw, target): occurrences over all rows and over the rows with a true ``trusted`` flag."""
    names = _names(df)
    flag = F.lit(False) if trusted is None else F.coalesce(F.col(trusted), F.lit(False))
    hashed = _hashed(df.select(text, flag.alias(names["repeats"])), text, names)
    every = F.explode(F.concat(names["hashes"], names["bigrams"]))
    grams = hashed.select(every.alias("gram"), F.col(names["repeats"]).cast("long").alias("trusted"))
    grams = grams.select(_bucket(F.col("gram"), buckets).alias("bucket"), "trusted")
    return grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("trusted").alias("target"))


def log_ratios(counts: DataFrame, buckets: int, coarse: float = 0.0) -> DataFrame:
    """(bucket, ratio): by bucket the log of seen over expected occurrences in the target, in units.

    Expected is the share of the raw corpus times the size of the target. ``coarse`` is the part that the ratio of half as
    many buckets has in it. A bucket without occurrences has the ratio 0 and no row.
    """
    totals = counts.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).first()
    if not totals["target"]:
        return counts.select("bucket", F.lit(0).cast("long").alias("ratio"))

    def ratio(raw: Column, target: Column) -> Column:
        expected = raw * totals["target"] / totals["raw"]
        return F.log((target + PRIOR) / (expected + PRIOR))

    half = _bucket(F.col("bucket"), buckets // 2)
    both = counts.groupBy(half.alias("half")).agg(F.sum("raw").alias("half_raw"), F.sum("target").alias("half_target"))
    blended = (1 - coarse) * ratio(F.col("raw"), F.col("target")) + coarse * ratio(F.col("half_raw"), F.col("half_target"))
    met = counts.withColumn("half", half).join(both, "half")
    return met.select("bucket", F.round(blended / UNIT).cast("long").alias("ratio"))


def fit(
    raw: DataFrame, trusted_ids: DataFrame, id_column: str = "doc_id", text: str = "text", buckets: float | None = None
) -> Model:
    """The written model of the raw corpus and of its documents with a trusted id; ``buckets`` fixes their wished number."""
    flag = free_name(raw.columns, "__trusted")
    key = free_name(raw.columns, "__key")
    wished = buckets or wished_buckets(count_grams(raw, text))
    power = math.ceil(math.log2(wished))
    ids = trusted_ids.select(F.col(id_column).alias(key)).where(F.col(key).isNotNull()).distinct()
    ids = small_side(written(ids, "trusted-ids")).withColumn(flag, F.lit(True))
    rows = raw.select(F.col(id_column), F.col(text)).join(ids, F.col(id_column) == F.col(key), "left")
    counts = written(bucket_counts(rows.select(text, flag), text, flag, 1 << power), "bucket-counts")
    ratios = log_ratios(counts, 1 << power, power - math.log2(wished))
    return Model(written(ratios, "log-ratios"), 1 << power)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: a lambda variable is not written out again by the optimizer."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(windows: Column) -> Column:
    """Words in windows that occur twice or more; windows are hashes, in order of the text."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    some = F.size(F.array_distinct(windows)) < F.size(windows)
    return F.when(some, _let(placed, _covered)).otherwise(F.lit(0).cast("long"))


def _covered(placed: Column) -> Column:
    # try_element_at gives NULL past an end; index 0 is not allowed, hence the first case.
    again = F.filter(
        placed,
        lambda p, k: F.coalesce(F.when(k > 0, F.try_element_at(placed, F.greatest(k, F.lit(1)))["h"] == p["h"]), F.lit(False))
        | F.coalesce(F.try_element_at(placed, k + 2)["h"] == p["h"], F.lit(False)),
    )
    starts = F.sort_array(F.transform(again, lambda p: p["i"]))
    state = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
    step = lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(F.lit(WINDOW), i - s["last"])).alias("n"))
    return F.aggregate(starts, state, step, lambda s: s["n"])


def _text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b")]


def text_ratios(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """(a, b, mean): by the hashes of each distinct text with words its mean log ratio."""
    names = _names(df)
    # Keys are made before n-grams are dealt out: once a text.
    texts = df.select(F.col(text).alias("text"), *_text_key(F.col(text))).where(F.col(text).isNotNull())
    hashed = _hashed(texts, "text", names)
    grams = hashed.select("a", "b", F.explode(F.concat(names["hashes"], names["bigrams"])).alias("gram"))
    grams = grams.select("a", "b", _bucket(F.col("gram"), model.buckets).alias("bucket"))
    sums = grams.join(small_side(model.ratios, BROADCAST_BUCKETS), "bucket", "left").groupBy("a", "b")
    # Rows with the same text add as often to the sum as to the number.
    sums = sums.agg(F.sum(F.coalesce("ratio", F.lit(0))).alias("ratio"), F.count("*").alias("n"))
    return sums.select("a", "b", (F.col("ratio") * UNIT / F.col("n")).alias("mean"))


def _base(body: Column) -> Column:
    """The counts of a text, each step of which is computed once."""

    def counted(own: Column, hashes: Column, bigrams: Column) -> Column:
        five = lambda last, i: F.xxhash64(F.get(bigrams, i), F.get(bigrams, i + 2), last)
        lines = F.filter(F.split(body, "\n"), lambda line: F.trim(line, F.lit(SPACE_CHARS)) != "")
        return F.struct(
            F.size(own).cast("long").alias("n_words"),
            F.char_length(F.array_join(own, "")).cast("long").alias("word_chars"),
            (F.size(F.split(body, SYMBOLS)) - 1).cast("long").alias("n_symbols"),
            _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _let(F.transform(_from(hashes, WINDOW - 1), five), _repeated_words).alias("n_repeat_words"),
        )

    hashed = lambda own, then: _let(F.transform(own, lambda w: F.xxhash64(w)), then)
    paired = lambda own, h: _let(_pairs(_upto(h, 1), _from(h, 1)), lambda b: counted(own, h, b))
    return _let(words(body), lambda own: hashed(own, lambda h: paired(own, h)))


def judge(df: DataFrame, model: Model, text: str = "text", into: str = "quality") -> DataFrame:
    """Add a struct ``into``: the base counts, base_failed, ratio (mean log ratio; 0 without words), kept."""
    found = {k: free_name(df.columns, f"__{k}") for k in ("a", "b", "mean")}
    ratios = written(text_ratios(df, model, text), "text-ratios").withColumnsRenamed(found)
    keys = zip(_text_key(F.col(text)), (found["a"], found["b"]), strict=True)
    a, b = (key == F.col(name) for key, name in keys)

    def verdict(counted: Column, mean: Column) -> Column:
        ratio = F.coalesce(mean, F.lit(0.0))
        failed = (counted["n_words"] < MIN_WORDS) | (100 * counted["n_repeat_words"] > MAX_REPEATED_PERCENT * counted["n_words"])
        return F.struct(
            *(counted[k].alias(k) for k in BASE[:-1]),
            failed.alias("base_failed"),
            ratio.alias("ratio"),
            (~failed & (ratio >= MIN_RATIO)).alias("kept"),
        )

    judged = _let(_base(F.coalesce(F.col(text), F.lit(""))), lambda counted: verdict(counted, F.col(found["mean"])))
    return df.join(ratios, a & b, "left").select(*(df[c] for c in df.columns), judged.alias(into))


def keep_good(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows that are kept, with their own columns only."""
    verdict = free_name(df.columns, "__quality")
    # A filter pushed below would make the counts twice.
    return kept_rows(judge(df, model, text, verdict), F.col(verdict)["kept"]).drop(verdict)
