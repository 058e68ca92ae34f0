"""Incremental loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.grouping import latest_per_key
from lakeloom.session import working_folder


def upsert(base: DataFrame, changes: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """Base with changed rows replaced and new ones added; of base and changes the newest row counts.

    ``newest`` are columns of both; a change as new as the base row replaces it. Changes are reduced to one a key
    and written once, so their true size is known: a small set is broadcast, and the base, which is read in
    whole once and once for its keys, never moves.
    """
    keys, spark = list(keys), base.sparkSession
    final = latest_per_key(changes, keys, newest, [c for c in changes.columns if c not in keys])
    folder = working_folder(spark, "changes")
    final.select(*base.columns).write.parquet(folder)
    final = spark.read.schema(final.select(*base.columns).schema).parquet(folder)

    change = final.select(*keys, F.struct(*base.columns).alias("_change"))
    met = base.join(change, keys, "left")
    wins = F.struct(*[F.col(f"_change.{c}") for c in newest]) >= F.struct(*newest)
    taken = [F.when(F.col("_change").isNotNull() & wins, F.col(f"_change.{c}")).otherwise(F.col(c)).alias(c) for c in base.columns]
    # Which changed keys the base has is found beside the changes, as they are the small side.
    held = base.select(*keys).join(final.select(*keys), keys, "left_semi").distinct()
    return met.select(*taken).unionByName(final.join(held, keys, "left_anti"))
