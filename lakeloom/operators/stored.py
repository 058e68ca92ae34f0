"""Partial results kept by day and merged on read: exact distinct counts as bitmaps, medians as sketches.

A day is computed once. A month, a quarter or a cohort merges its days, so a late day adds its own partials and
nothing is counted again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMBER = "member_number"
# Up to so many values a sketch keeps all of them; beyond, the rank of its median is off by at most RANK_ERROR of them.
SKETCH_SIZE = 4096
RANK_ERROR = 0.002


def new_members(facts: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """Keys that have no number yet, with one each. NULL is no member.

    Numbers are consecutive within a task, which keeps bitmaps dense. They are fixed only once the result has been
    written, so write it before using it; a number never changes afterwards.
    """
    keys = facts.select(key).where(F.col(key).isNotNull()).distinct()
    first = 0
    if known is not None:
        keys = keys.join(known, key, "left_anti")
        first = known.agg(F.coalesce(F.max(NUMBER) + 1, F.lit(0))).first()[0]
    return keys.select(key, (F.lit(first) + F.monotonically_increasing_id()).alias(NUMBER))


def member_bitmaps(facts: DataFrame, by: Sequence[str], key: str, members: DataFrame) -> DataFrame:
    """Who occurs in a group, as bitmaps of 32,768 members each. A group of NULLs alone has an empty one."""
    numbered = facts.select(*by, key).join(members, key, "left")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(NUMBER)).alias("bitmap")
    return numbered.groupBy(*by, F.bitmap_bucket_number(NUMBER).alias("bucket")).agg(bits)


def distinct_members(bitmaps: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Exact distinct counts of any coarser grouping: bitmaps are or-ed, bits counted, buckets added up."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).alias(name))


def value_sketches(facts: DataFrame, by: Sequence[str], value: Column) -> DataFrame:
    """A quantile sketch of bounded size per group, an empty one for a group without values."""
    return facts.groupBy(*by).agg(F.kll_sketch_agg_double(value.cast("double"), SKETCH_SIZE).alias("sketch"))


def merged_median(sketches: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Lower median of any coarser grouping: exact up to ``SKETCH_SIZE`` values, within ``RANK_ERROR`` beyond; NULL without any."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", SKETCH_SIZE).alias("sketch"))
    median = F.when(F.kll_sketch_get_n_double("sketch") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)))
    return merged.select(*by, median.alias(name))
