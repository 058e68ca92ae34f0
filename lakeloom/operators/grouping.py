"""One row per key without sending a whole key to one task.

All of them aggregate (partial per map task, then final) instead of ranking in a window, so a
key holding a third of the table still arrives at the reducer as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Row with the greatest ``newest`` tuple per key, NULL counting as oldest.

    Later columns of ``newest`` break ties, which makes the choice deterministic.
    """
    picked = F.max_by(F.struct(*keep), F.struct(*newest)).alias("picked")
    return df.groupBy(*keys).agg(picked).select(*keys, "picked.*")


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop duplicate keys; of differing rows the smallest in column order stays."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    picked = F.min(F.struct(*rest)).alias("picked")
    return df.groupBy(*keys).agg(picked).select(*keys, "picked.*").select(*df.columns)


def mode_per_key(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Most frequent combination of ``values`` per key; ties go to the smallest, NULL first."""
    counted = df.groupBy(*keys, *values).agg((-F.count("*")).alias("rarity"))
    picked = F.min(F.struct("rarity", *values)).alias("picked")
    return counted.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"picked.{v}") for v in values])


def median_per_key(df: DataFrame, keys: Sequence[str], **medians: Column) -> DataFrame:
    """Independent lower medians per key, from mergeable sketches of bounded size."""
    return df.groupBy(*keys).agg(*[F.percentile_approx(c, 0.5).alias(name) for name, c in medians.items()])
