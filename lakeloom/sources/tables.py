"""Published tables: write a new folder, audit it, then let readers see it.

Every publish writes ``<root>/<table>/version=N`` and marks it once its primary key has passed;
readers take the greatest marked version. A table can thus be rebuilt from itself, a failed check
leaves the last good version in place, and nothing has to be cached between check and write.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeloom.session import short_shuffles
from lakeloom.sources import paths

MARKER = "_PUBLISHED"

# Keys are digests in hexadecimal, which zstd halves and snappy leaves as they are.
CODEC = "zstd"

# Schemas of version folders already seen. A version never changes, so its footers are read once.
_SCHEMAS: dict[str, StructType] = {}


class KeyViolation(ValueError):
    """The primary key is duplicated or NULL."""


class SchemaDrift(ValueError):
    """The columns differ from those of the published version."""


def _versions(spark: SparkSession, path: str, marker: str = "") -> list[int]:
    pattern = f"{path}/version=*"
    found = paths.folders_with(spark, pattern, marker) if marker else paths.names(spark, pattern)
    return sorted(int(name.split("=", 1)[1]) for name in found)


def table_exists(spark: SparkSession, root: str, table: str) -> bool:
    return bool(_versions(spark, f"{root}/{table}", MARKER))


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Latest published version."""
    published = _versions(spark, f"{root}/{table}", MARKER)
    if not published:
        raise ValueError(f"{table} was never published below {root}")
    return _read_version(spark, f"{root}/{table}/version={published[-1]}")


def _read_version(spark: SparkSession, folder: str) -> DataFrame:
    if folder not in _SCHEMAS:
        _SCHEMAS[folder] = spark.read.parquet(folder).schema
    return spark.read.schema(_SCHEMAS[folder]).parquet(folder)


def key_profile(df: DataFrame, primary_key: Sequence[str]) -> DataFrame:
    """Row count and number of distinct complete keys, in one pass.

    A key with a NULL part is not counted as distinct, so the comparison catches both faults.
    """
    return df.agg(
        F.count("*").alias("row_count"), F.count_distinct(*[F.col(c) for c in primary_key]).alias("distinct_keys")
    )


def check_key(df: DataFrame, table: str, primary_key: Sequence[str]) -> int:
    """Number of rows, or ``KeyViolation``."""
    profile = key_profile(df, primary_key).first()
    if profile.row_count != profile.distinct_keys:
        raise KeyViolation(
            f"{table}: {profile.distinct_keys} distinct values of {list(primary_key)} in {profile.row_count} rows"
        )
    return profile.row_count


def _signature(df: DataFrame) -> list[tuple[str, str]]:
    return [(field.name, field.dataType.simpleString()) for field in df.schema.fields]


def stage(
    df: DataFrame,
    root: str,
    table: str,
    primary_key: Sequence[str],
    overwrite_schema: bool = False,
    partition_by: Sequence[str] = (),
) -> tuple[str, int]:
    """Write the next version and check its key; nobody reads it before it is released. Returns its folder and rows."""
    spark, path = df.sparkSession, f"{root}/{table}"
    if table_exists(spark, root, table) and not overwrite_schema:
        published = read_table(spark, root, table)
        if sorted(_signature(published)) != sorted(_signature(df)):
            raise SchemaDrift(f"{table}: {_signature(df)} instead of {_signature(published)}")
    version = max(_versions(spark, path), default=0) + 1
    target = f"{path}/version={version}"
    with short_shuffles(spark):
        # errorifexists: of two writers that picked the same number, one fails.
        df.write.mode("errorifexists").option("compression", CODEC).partitionBy(*partition_by).parquet(target)
        if not partition_by:
            _SCHEMAS[target] = df.schema
        return target, check_key(_read_version(spark, target), table, primary_key)


def read_staged(spark: SparkSession, folder: str) -> DataFrame:
    """A version by its folder, released or not."""
    return _read_version(spark, folder)


def release(spark: SparkSession, folder: str) -> None:
    """Let readers see a staged version."""
    paths.touch(spark, f"{folder}/{MARKER}")


def retire(spark: SparkSession, root: str, table: str, keep: int = 2) -> list[int]:
    """Delete what is older than the last ``keep`` published versions; returns the numbers that went.

    Refused and abandoned versions older than these go too, later ones may still be being written. A reader that
    began on a version fails once it is gone, so ``keep`` should cover the longest job that reads the table.
    """
    if keep < 1:
        raise ValueError("the published version cannot be retired")
    path = f"{root}/{table}"
    kept = _versions(spark, path, MARKER)[-keep:]
    old = [n for n in _versions(spark, path) if kept and n < kept[0]]
    for n in old:
        # The marker goes first: what is half deleted is no longer published.
        paths.remove(spark, f"{path}/version={n}/{MARKER}")
        paths.remove(spark, f"{path}/version={n}")
        _SCHEMAS.pop(f"{path}/version={n}", None)
    return old


def publish(df: DataFrame, root: str, table: str, primary_key: Sequence[str], **how) -> int:
    """Publish a full rebuild of a table and return its number of rows; takes what ``stage`` takes."""
    folder, rows = stage(df, root, table, primary_key, **how)
    release(df.sparkSession, folder)
    return rows
