"""Type-2 history kept with joins and unions, as plain Parquet has no MERGE."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions.constants import FIRST_VALID_FROM, OPEN_VALID_TO
from lakeloom.functions.keys import version_key


@dataclass(frozen=True)
class HistorySpec:
    """What identifies a member, what opens a new version, what merely travels along."""

    natural: str
    surrogate: str
    tracked: Sequence[str]
    carried: Sequence[str] = ()

    @property
    def columns(self) -> list[str]:
        return [self.surrogate, self.natural, *self.tracked, *self.carried, "valid_from", "valid_to", "is_current"]


def _day(value: date) -> Column:
    return F.lit(value).cast("date")


def changed(spec: HistorySpec, left: str, right: str) -> Column:
    """True where a tracked attribute differs; NULL against a value is a difference."""
    differs = [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in spec.tracked]
    return reduce(or_, differs)


def versions(rows: DataFrame, spec: HistorySpec, since: Column, until: Column, current: Column) -> DataFrame:
    """Rows as versions: one projection to the columns of the history."""
    told = {"valid_from": since, "valid_to": until, "is_current": current}
    told[spec.surrogate] = version_key(spec.natural, since)
    return rows.select(*[told.get(c, F.col(c)).alias(c) for c in spec.columns])


def open_versions(snapshot: DataFrame, spec: HistorySpec, valid_from: date) -> DataFrame:
    """Every snapshot row as a current version starting on ``valid_from``."""
    return versions(snapshot, spec, _day(valid_from), _day(OPEN_VALID_TO), F.lit(True))


def first_load(snapshot: DataFrame, spec: HistorySpec) -> DataFrame:
    """The first snapshot holds since ever, so that earlier facts find a version."""
    return open_versions(snapshot, spec, FIRST_VALID_FROM)


def merge_snapshot(history: DataFrame, snapshot: DataFrame, spec: HistorySpec, as_of: date) -> DataFrame:
    """History after one more snapshot.

    A changed member is closed the day before ``as_of`` and reopened, a new one is opened, an
    unchanged one and one missing from the snapshot stay as they are. Closed versions meet no
    candidate and pass through the same join, so the history is read once.
    """
    known = history.select(F.struct(*spec.columns).alias("cur"))
    candidate = open_versions(snapshot, spec, as_of).select(F.struct(*spec.columns).alias("new"))
    same = (F.col(f"cur.{spec.natural}") == F.col(f"new.{spec.natural}")) & F.col("cur.is_current")
    closed = F.col("cur").withField("valid_to", _day(as_of - timedelta(days=1))).withField("is_current", F.lit(False))
    outcome = (
        F.when(F.col("cur").isNull(), F.array("new"))
        .when(F.col("new").isNotNull() & changed(spec, "cur", "new"), F.array(closed, F.col("new")))
        .otherwise(F.array("cur"))
    )
    return known.join(candidate, same, "full_outer").select(F.explode(outcome).alias("row")).select("row.*")


def merge_counts(as_of: date) -> list[Column]:
    """Aggregates over a merged history that tell what the load on ``as_of`` did."""
    opened = F.col("valid_from") == _day(as_of)
    closed = ~F.col("is_current") & (F.col("valid_to") == _day(as_of - timedelta(days=1)))
    return [
        F.count_if(opened).alias("inserted"),
        F.count_if(closed).alias("closed"),
        F.count_if(closed).alias("changed_detected"),
    ]


def history_from_snapshots(
    snapshots: DataFrame, spec: HistorySpec, first_as_of: date, as_of: str = "as_of"
) -> DataFrame:
    """Whole history in one pass over stacked snapshots; equal to merging them one by one.

    A member has one row per snapshot date, so its window stays as short as the list of dates.
    """
    per_member = Window.partitionBy(spec.natural).orderBy(as_of)
    opened = (
        snapshots.withColumn("_state", F.struct(*spec.tracked))
        .withColumn("_before", F.lag("_state").over(per_member))
        .where(F.col("_before").isNull() | ~F.col("_state").eqNullSafe(F.col("_before")))
    )
    following = opened.withColumn("_next", F.lead(as_of).over(per_member))
    since = F.when(F.col(as_of) == _day(first_as_of), _day(FIRST_VALID_FROM)).otherwise(F.col(as_of))
    until = F.coalesce(F.date_sub("_next", 1), _day(OPEN_VALID_TO))
    return versions(following, spec, since, until, F.col("_next").isNull())


def history_violations(history: DataFrame, spec: HistorySpec) -> DataFrame:
    """Members whose history is broken: not exactly one current row, inverted or overlapping ranges.

    The window holds one member's versions, at most one per load date.
    """
    per_member = Window.partitionBy(spec.natural).orderBy("valid_from", "valid_to")
    marked = history.withColumn("_next", F.lead("valid_from").over(per_member))
    return (
        marked.groupBy(spec.natural)
        .agg(
            F.count_if("is_current").alias("current_rows"),
            F.count_if(F.col("valid_to") < F.col("valid_from")).alias("inverted"),
            F.count_if(F.col("_next") <= F.col("valid_to")).alias("overlapping"),
        )
        .where("current_rows <> 1 OR inverted > 0 OR overlapping > 0")
    )
