"""Unknown members and dimension lookups."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.constants import UNKNOWN_KEY, UNKNOWN_LABEL
from lakeloom.functions.keys import key_bytes, resolve_key, surrogate_key
from lakeloom.session import written


# Length of the periods that long histories are cut into, and the day from which a first version is valid at the latest
# if it is valid since ever.
PERIOD_DAYS = 64
MANY_VERSIONS = 32
NO_BEGINNING = date(1900, 1, 1)

# What an unknown member shows by type; a type that is not listed shows NULL, as any number would be a claim.
SHOWN = {"string": UNKNOWN_LABEL}


def unknown_row(spark: SparkSession, shape: dict[str, str], own: dict[str, object]) -> DataFrame:
    """One row of the given columns and types; ``own`` holds what is not told by the type."""
    if strange := own.keys() - shape.keys():
        raise ValueError(f"{sorted(strange)} not among the columns {list(shape)}")
    values = {c: own.get(c, SHOWN.get(kind)) for c, kind in shape.items()}
    return spark.range(1).select(*[F.lit(values[c]).cast(kind).alias(c) for c, kind in shape.items()])


def with_unknown_member(df: DataFrame, key: str, unknown_key: str = UNKNOWN_KEY) -> DataFrame:
    """The dimension and the row that facts without a match point at."""
    return df.unionByName(unknown_row(df.sparkSession, dict(df.dtypes), {key: unknown_key}))


def irregular(dim: DataFrame, ids: Sequence[str], surrogate: str, rule: Column) -> DataFrame:
    """Members, with their keys, whose ids are not those of exactly one row with the key that the rule gives."""
    follows = F.col(surrogate).eqNullSafe(rule)
    groups = dim.groupBy(*ids).agg(F.count("*").alias("_rows"), F.count_if(follows).alias("_following"))
    strange = groups.where("_rows <> 1 OR _following <> 1").select(*ids)
    return dim.select(*ids, surrogate).join(strange, list(ids)).withColumn(surrogate, resolve_key(surrogate))


def with_exceptions(facts: DataFrame, dim: DataFrame, natural: str, surrogate: str, found: str) -> DataFrame:
    """Left join each fact to its member; ``found`` is the key only where it is not the digest of the id, otherwise NULL.

    Of the facts only their distinct ids move. Those without a member and the irregular members are written with their
    keys, so Catalyst knows how few they are, or joins them as any other table.
    """
    ids = facts.select(natural).where(F.col(natural).isNotNull()).distinct()
    unknown = ids.join(dim.select(natural), natural, "left_anti").withColumn(surrogate, F.lit(UNKNOWN_KEY))
    own = irregular(dim, [natural], surrogate, surrogate_key(natural))
    strange = unknown.unionByName(own).withColumnRenamed(surrogate, found)
    return facts.join(written(strange, "exceptions"), natural, "left")


def join_on_digest(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Inner join on a digest, of which only the bytes move; the key itself is not among the columns of the result."""
    sides = [df.withColumn("_key", key_bytes(key)).drop(key) for df in (facts, dim)]
    return sides[0].join(sides[1], "_key").drop("_key")


def point_in_time(
    facts: DataFrame, history: DataFrame, natural: str, moment: str, carry: list[str]
) -> DataFrame:
    """Left join each fact to the version valid on ``moment`` (closed date intervals).

    Equality on the natural key drives the join and the interval is a residual condition, so
    Catalyst broadcasts a small history and sort-merges a large one, splitting hot keys.
    """
    versions = history.select(F.col(natural).alias("_natural"), "valid_from", "valid_to", *carry)
    valid = F.col(moment).between(F.col("valid_from"), F.col("valid_to"))
    joined = facts.join(versions, (F.col(natural) == F.col("_natural")) & valid, "left")
    return joined.drop("_natural", "valid_from", "valid_to")


def periods(history: DataFrame, natural: str, days: int = PERIOD_DAYS) -> tuple[DataFrame, tuple[int, int]]:
    """Versions cut into periods of equal length (``_period``), and the first and last period that any version begins in.

    What lies before or behind belongs to the outermost periods, so a version without an end has no more
    periods than the history is long.
    """
    starts = _period(F.col("valid_from"), days)
    bounds = history.where(F.col("valid_from") > F.lit(NO_BEGINNING)).agg(F.min(starts).alias("lo"), F.max(starts).alias("hi")).first()
    lo, hi = (bounds.lo, bounds.hi) if bounds.lo is not None else (0, 0)
    within = [_clamped(_period(F.col(c), days), lo, hi) for c in ("valid_from", "valid_to")]
    return history.where("valid_from <= valid_to").withColumn("_period", F.explode(F.sequence(*within))), (lo, hi)


def _period(day: Column, days: int) -> Column:
    return F.floor(F.unix_date(day) / days).cast("int")


def _clamped(period: Column, lo: int, hi: int) -> Column:
    return F.least(F.greatest(period, F.lit(lo)), F.lit(hi))


def point_in_time_by_period(
    facts: DataFrame, history: DataFrame, natural: str, moment: str, carry: list[str], days: int = PERIOD_DAYS
) -> DataFrame:
    """As ``point_in_time``, for members with many versions: the join is on the member and the period of the moment.

    A fact meets the versions of its period only, however many the member has had before and since. A history
    of few versions a member is better joined as it is, since periods make it longer.
    """
    cut, (lo, hi) = periods(history, natural, days)
    versions = cut.select(F.col(natural).alias("_natural"), "_period", "valid_from", "valid_to", *carry)
    on_day = _clamped(_period(F.col(moment), days), lo, hi)
    same = (F.col(natural) == F.col("_natural")) & (on_day == F.col("_period"))
    valid = F.col(moment).between(F.col("valid_from"), F.col("valid_to"))
    return facts.join(versions, same & valid, "left").drop("_natural", "_period", "valid_from", "valid_to")


def version_at(facts: DataFrame, history: DataFrame, natural: str, moment: str, carry: list[str]) -> DataFrame:
    """``point_in_time``, by periods if any member has more than ``MANY_VERSIONS``; the result is the same."""
    most = history.groupBy(natural).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    join = point_in_time_by_period if most > MANY_VERSIONS else point_in_time
    return join(facts, history, natural, moment, carry)


def as_of_date(history: DataFrame, moment) -> DataFrame:
    """The dimension as it stood on one day."""
    return history.where(F.lit(moment).cast("date").between(F.col("valid_from"), F.col("valid_to")))
