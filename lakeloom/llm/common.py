"""What several operators need: tables cut from their lineage, free column names, words."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable
from typing import Any

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.session import working_folder

# White space that ends a word, as the inside of a character class.
SPACE = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\f\r"
# A side of a join is broadcast only up to this many rows of two numbers (some 30 MB when hashed).
BROADCAST_ROWS = 1_000_000


def given(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the shared folder: no lineage to repeat when executors are lost, sizes known."""
    spark = df.sparkSession
    path = working_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(taken: Iterable[str], wish: str) -> str:
    """A column name like ``wish`` that is not among ``taken`` (names differ by more than case)."""
    used = {name.lower() for name in taken}
    while wish.lower() in used:
        wish = f"_{wish}"
    return wish


def beside(kept: Iterable[str], added: Iterable[str]) -> list[str]:
    """Names of kept columns next to added ones: a kept one of an added name goes on under a free one."""
    kept, new = list(kept), {name.lower() for name in added}
    taken, names = [*kept, *new], []
    for name in kept:
        if name.lower() in new:
            name = free_name(taken, name)
            taken.append(name)
        names.append(name)
    return names


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if the table, counted first, is small; else leave the join to a shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def words(text: Column) -> Column:
    """Runs of characters other than ASCII white space; none for NULL."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACE}]+"))


_MADE: dict[str, Any] = {}


def shared_value(spark: SparkSession, value: Any) -> Broadcast:
    """A value of bounded size for all tasks; ``made_once`` takes it there, and knows equal texts again."""
    key = hashlib.sha256(value.encode()).hexdigest() if isinstance(value, str) else uuid.uuid4().hex
    return spark.sparkContext.broadcast((key, value))


def made_once(shared: Broadcast, make: Callable[[Any], Any]) -> Any:
    """What ``make`` builds of a shared value, built once in each worker; the last two are kept."""
    key, value = shared.value
    if key not in _MADE:
        while len(_MADE) >= 2:
            _MADE.pop(next(iter(_MADE)))
        _MADE[key] = make(value)
    return _MADE[key]


def kept_rows(df: DataFrame, condition: Column) -> DataFrame:
    """Filter on computed columns as they are: a row number keeps Catalyst from writing them out again below."""
    number = free_name(df.columns, "__number")
    return df.withColumn(number, F.monotonically_increasing_id()).where(condition & (F.col(number) >= 0)).drop(number)
