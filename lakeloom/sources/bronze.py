"""Bronze: one untouched text snapshot per table and ingestion day."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.keys import batch_id
from lakeloom.sources import landing, paths

PARTITION = "ingestion_date"
SOURCES = [
    "customers",
    "sellers",
    "products",
    "categories",
    "geolocation",
    "orders",
    "order_items",
    "payments",
    "reviews",
]


def with_audit(df: DataFrame, table: str, ingested_at: datetime, source_file: str) -> DataFrame:
    """Audit columns: load moment, file of origin, batch. The moment is the caller's, not the clock's."""
    return df.select(
        "*",
        F.lit(ingested_at).cast("timestamp").alias("_ingested_at"),
        F.lit(source_file).alias("_source_file"),
        F.lit(batch_id(table, ingested_at.date())).alias("_batch_id"),
    )


def write_bronze(df: DataFrame, root: str, table: str, ingestion_date: date) -> None:
    """Replace this day's snapshot and no other, so a re-run adds nothing."""
    (
        df.withColumn(PARTITION, F.lit(ingestion_date).cast("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION)
        .parquet(f"{root}/{table}")
    )


def ingestion_dates(spark: SparkSession, root: str, table: str) -> list[date]:
    """Days present, from the folder names alone."""
    found = paths.names(spark, f"{root}/{table}/{PARTITION}=*")
    return [date.fromisoformat(name.split("=", 1)[1]) for name in found]


def resolve_ingestion_date(spark: SparkSession, root: str, table: str, requested: date | None = None) -> date:
    """The requested day if it was ingested, else the latest one."""
    available = ingestion_dates(spark, root, table)
    if not available:
        raise ValueError(f"{table} was never ingested below {root}")
    if requested is None:
        return max(available)
    if requested not in available:
        raise ValueError(f"{table} has no snapshot of {requested}; there are {available}")
    return requested


def read_bronze(spark: SparkSession, root: str, table: str, ingestion_date: date | None = None) -> DataFrame:
    """Exactly one snapshot. A union of days would bring deleted records back."""
    day = resolve_ingestion_date(spark, root, table, ingestion_date)
    return spark.read.parquet(f"{root}/{table}/{PARTITION}={day.isoformat()}")


def ingest(
    spark: SparkSession, landing_root: str, root: str, table: str, ingested_at: datetime, line_breaks: bool | None = None
) -> None:
    """One extract from landing to bronze, under the day it was ingested."""
    extract = landing.read_landing(spark, landing_root, table, line_breaks)
    audited = with_audit(extract, table, ingested_at, f"{table}.csv")
    write_bronze(audited, root, table, ingested_at.date())


class BronzeDay:
    """The sources of one ingestion day by name; the latest day of each without one."""

    def __init__(self, spark: SparkSession, root: str, day: date | None = None):
        self.spark = spark
        self.folder = f"{root}@{day or 'latest'}"
        self._root = root
        self._day = day

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SOURCES:
            raise AttributeError(name)
        return read_bronze(self.spark, self._root, name, self._day)
