"""Data checks. Each returns the rows that break a rule; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicated(df: DataFrame, *keys: str) -> DataFrame:
    """``unique``: keys that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count("*").alias("occurrences")).where("occurrences > 1")


def missing(df: DataFrame, *columns: str) -> DataFrame:
    """``not_null``: rows with a NULL in any of the columns."""
    return df.where(reduce(or_, [F.col(c).isNull() for c in columns]))


def unaccepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """``accepted_values``: other values with their frequency; NULL passes."""
    return df.where(~F.col(column).isin(*values)).groupBy(column).agg(F.count("*").alias("occurrences"))


def orphans(df: DataFrame, foreign: str, parent: DataFrame, key: str) -> DataFrame:
    """``relationships``: rows whose non-NULL reference has no parent."""
    known = parent.select(F.col(key).alias("_known"))
    return df.where(F.col(foreign).isNotNull()).join(known, F.col(foreign) == F.col("_known"), "left_anti")


def cohort_violations(mart: DataFrame) -> DataFrame:
    """Cohorts where more came back than were there, or fewer within a longer window."""
    n = {months: F.col(f"recompra_{months}m") for months in (3, 6, 12)}
    too_many = [column > F.col("clientes_cohorte") for column in n.values()]
    shrinking = [n[3] > n[6], n[6] > n[12]]
    return mart.where(reduce(or_, [*too_many, *shrinking])).select(
        "cohort_year_month", "clientes_cohorte", "recompra_3m", "recompra_6m", "recompra_12m"
    )


def outside_box(df: DataFrame, lat: tuple[float, float], lng: tuple[float, float]) -> DataFrame:
    """Points with either coordinate out of bounds."""
    return df.where(~F.col("lat").between(*lat) | ~F.col("lng").between(*lng))


def null_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of NULLs per column, all columns in one pass."""
    counted = df.agg(F.count("*").alias("row_count"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns]
    return counted.select("row_count", F.explode(F.array(*pairs)).alias("p")).select(
        "p.column_name", "p.nulls", "row_count", (F.col("p.nulls") / F.col("row_count")).alias("null_rate")
    )


def tag_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add the ids of all broken rules. A rule that evaluates to NULL counts as kept."""
    broken = [F.when(condition, F.lit(rule)) for rule, condition in rules.items()]
    return df.withColumn("violations", F.array_compact(F.array(*broken)))


def split_quarantine(
    df: DataFrame, rules: Mapping[str, Column], errors: Mapping[str, str], audit: Mapping[str, Column]
) -> tuple[DataFrame, DataFrame]:
    """Rows that keep all rules, and one quarantine row per broken rule with its error text."""
    tagged = tag_violations(df, rules)
    texts = F.create_map(*[F.lit(v) for pair in errors.items() for v in pair])
    good = tagged.where(F.size("violations") == 0).drop("violations")
    bad = tagged.withColumn("rule_id", F.explode("violations")).drop("violations")
    return good, bad.select(
        "*", F.element_at(texts, F.col("rule_id")).alias("error_text"), *[c.alias(n) for n, c in audit.items()]
    )
