"""Serving copy of published tables to a relational database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakeloom.functions.constants import JDBC_BATCH_ROWS


def copy_to_jdbc(
    df: DataFrame, url: str, target: str, properties: Mapping[str, str], connections: int = 8
) -> int:
    """Replace the rows of ``target`` and return how many were written.

    ``truncate`` keeps the table with its grants and dependent views; ``numPartitions`` bounds
    the connections. The count is observed while writing, so the source is read once.
    """
    written = Observation()
    (
        df.observe(written, F.count(F.lit(1)).alias("row_count"))
        .write.mode("overwrite")
        .option("truncate", "true")
        .option("batchsize", str(JDBC_BATCH_ROWS))
        .option("numPartitions", str(connections))
        .jdbc(url, target, properties=dict(properties))
    )
    return written.get["row_count"]
