"""Bronze from files as they are delivered: each file is taken once, under the moment it was taken.

A table is kept either as snapshots by day (``bronze.ingest``) or as deliveries; the two layouts are not mixed
under one folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.sources import paths
from lakeloom.sources.bronze import PARTITION
from lakeloom.sources.landing import ONE_LINE_A_ROW

LOAD = "load"


def _columns(spark: SparkSession, folder: str) -> list[str]:
    found = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    return found.csv(folder, header=True, inferSchema=False, quote='"', escape='"', multiLine=True).columns


def ingest_new(
    spark: SparkSession, landing_root: str, root: str, table: str, checkpoint: str, line_breaks: bool | None = None
) -> int:
    """Take the files below ``<landing>/<table>`` that no earlier run has taken; returns the number of loads now there.

    The checkpoint knows the files that were taken. A run that died repeats its load under the same number and moment
    and replaces what it had written, so no row is lost or doubled. A file whose header differs from the columns of the
    table stops the run. No new file: nothing is written.
    """
    line_breaks = table not in ONE_LINE_A_ROW if line_breaks is None else line_breaks
    folder, target = f"{landing_root}/{table}", f"{root}/{table}"
    known = spark.read.parquet(target).columns if loads(spark, root, table) else None
    columns = [c for c in known if not c.startswith("_") and c not in (PARTITION, LOAD)] if known else _columns(spark, folder)
    source = (
        spark.readStream.schema(", ".join(f"`{c}` string" for c in columns))
        .options(header=True, enforceSchema=False, quote='"', escape='"', multiLine=line_breaks)
        .options(recursiveFileLookup=True, pathGlobFilter="*.csv")
        .csv(folder)
        .select(
            *[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns],
            F.current_timestamp().alias("_ingested_at"),
            F.col("_metadata.file_path").alias("_source_file"),
            F.col("_metadata.file_modification_time").alias("_delivered_at"),
        )
    )

    def write(new: DataFrame, load: int) -> None:
        dated = new.withColumns({LOAD: F.lit(load), PARTITION: F.to_date("_ingested_at")})
        writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(LOAD, PARTITION).parquet(target)

    running = source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    running.awaitTermination()
    return len(loads(spark, root, table))


def loads(spark: SparkSession, root: str, table: str) -> list[int]:
    """Loads that were written, from the folder names alone."""
    return sorted(int(name.split("=", 1)[1]) for name in paths.names(spark, f"{root}/{table}/{LOAD}=*"))


def load_moments(audited: DataFrame) -> DataFrame:
    """First moment at which rows of a day were there, for ``requirements.freshness``.

    What arrives on one morning holds the day before it. Rows without a load moment say nothing.
    """
    known = audited.where(F.col("_ingested_at").isNotNull())
    covered = F.date_sub(F.to_date("_ingested_at"), 1).alias("day")
    return known.groupBy(covered).agg(F.min("_ingested_at").alias("loaded_at"))
