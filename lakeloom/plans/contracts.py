"""The declared tests of gold tables and marts: 29 column tests, one mart rule, three history rules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.constants import DELIVERED
from lakeloom.operators import quality as Q
from lakeloom.operators.history import history_violations
from lakeloom.plans import silver
from lakeloom.plans.dimensions import SELLER_HISTORY
from lakeloom.plans.requirements import volume_gaps
from lakeloom.plans.star import Star

# Fixed values.
SEGMENTS = ("Bronze", "Silver", "Gold", "Unknown")
REGIONS = ("Norte", "Nordeste", "Centro-Oeste", "Sudeste", "Sul", "Unknown")
DELAYS = ("a tiempo", "1-3 dias", "4-7 dias", ">7 dias")

UNIQUE = {
    "dim_date": "date_sk",
    "dim_customer": "customer_sk",
    "dim_product": "product_sk",
    "dim_geography": "geography_sk",
    "dim_seller": "seller_sk",
    "fct_orders": "order_id",
    "mart_cohortes": "cohort_year_month",
}
NOT_NULL = {
    "dim_date": ["date_sk"],
    "dim_customer": ["customer_sk"],
    "dim_product": ["product_sk"],
    "dim_geography": ["geography_sk"],
    "dim_seller": ["seller_sk"],
    "fct_orders": ["order_id"],
    "mart_segmento_vendedor": ["year_month", "seller_segment", "gmv"],
    "mart_ventas_categoria": ["year_month", "product_category", "gmv"],
    "mart_satisfaccion": ["tramo_retraso", "score_medio"],
    "mart_cohortes": ["cohort_year_month", "clientes_cohorte"],
}
ACCEPTED = {
    ("dim_geography", "region"): REGIONS,
    ("dim_seller", "seller_segment"): SEGMENTS,
    ("mart_segmento_vendedor", "seller_segment"): SEGMENTS,
    ("mart_satisfaccion", "tramo_retraso"): DELAYS,
}
RELATIONSHIPS = {
    ("fct_orders", "customer_sk"): "dim_customer",
    ("fct_order_items", "seller_sk"): "dim_seller",
}


@dataclass(frozen=True)
class Check:
    """A named rule: what it looks at, and how many breaches are counted there.

    Checks of one ``subject`` are counted in one pass over its rows.
    """

    name: str
    subject: str
    rows: Callable[[Star], DataFrame]
    violations: Column
    layer: str = "gold"


def layer_of(table: str) -> str:
    return "marts" if table.startswith("mart_") else "gold"


def _column_check(kind: str, table: str, column: str, subject: str, rows: Callable[[Star], DataFrame], violations: Column) -> Check:
    return Check(f"{kind} {table}.{column}", subject, rows, violations, layer_of(table))


def declared_checks() -> list[Check]:
    every = F.count("*")
    checks = []
    for table, column in UNIQUE.items():
        keys = lambda s, t=table, c=column: s.table(t).groupBy(c).agg(F.count("*").alias("occurrences"))
        checks.append(_column_check("unique", table, column, f"keys of {table}", keys, F.count_if(F.col("occurrences") > 1)))
        if column in NOT_NULL.get(table, ()):
            nulls = F.sum(F.when(F.col(column).isNull(), F.col("occurrences")))
            checks.append(_column_check("not_null", table, column, f"keys of {table}", keys, F.coalesce(nulls, F.lit(0))))
    for table, columns in NOT_NULL.items():
        for column in columns:
            if column != UNIQUE.get(table):
                rows = lambda s, t=table: s.table(t)
                checks.append(_column_check("not_null", table, column, table, rows, F.count_if(F.col(column).isNull())))
    for (table, column), values in ACCEPTED.items():
        rows = lambda s, t=table, c=column, v=values: Q.unaccepted(s.table(t), c, v)
        checks.append(_column_check("accepted_values", table, column, f"values of {table}.{column}", rows, every))
    for (table, column), parent in RELATIONSHIPS.items():
        rows = lambda s, t=table, c=column, p=parent: Q.orphans(s.table(t), c, s.table(p), c)
        checks.append(_column_check("relationships", table, column, f"orphans of {table}.{column}", rows, every))
    checks.append(Check("repurchase within cohort", "cohorts", lambda s: Q.cohort_violations(s.mart_cohortes), every, "marts"))
    broken = {"one current version": "current_rows <> 1", "no inverted range": "inverted > 0", "no overlap": "overlapping > 0"}
    history = lambda s: history_violations(s.dim_seller, SELLER_HISTORY)
    checks += [Check(name, "history of dim_seller", history, F.count_if(F.expr(rule))) for name, rule in broken.items()]
    return checks


def lost_orders(star: Star) -> DataFrame:
    """Delivered orders of the source by day that the fact lacks; none may."""
    source = silver.orders(star.raw.orders, star.raw.customers).where(F.col("order_status") == DELIVERED)
    dated = source.select("order_id", F.to_date("order_purchase_timestamp").alias("bought_on"))
    return volume_gaps(dated, star.fct_orders, "order_id", "bought_on")


def gate_checks(layer: str) -> list[Check]:
    """What has to hold before a layer is released."""
    own = [check for check in declared_checks() if check.layer == layer]
    return [*own, Check("delivered orders are there", "lost orders", lost_orders, F.count("*"))] if layer == "gold" else own


def broken(star: Star, layer: str) -> dict[str, int]:
    """Checks of a layer that fail, with their violations."""
    report = check_report(star, gate_checks(layer)).where("violations > 0")
    return {row.check_name: row.violations for row in report.collect()}


def check_report(star: Star, checks: list[Check]) -> DataFrame:
    """Violations per check; each subject is read once, checks count where its rows are, only counts come together."""
    by_subject: dict[str, list[Check]] = {}
    for check in checks:
        by_subject.setdefault(check.subject, []).append(check)
    counted = []
    for same in by_subject.values():
        totals = same[0].rows(star).agg(*[c.violations.cast("bigint").alias(f"n{i}") for i, c in enumerate(same)])
        named = [F.struct(F.lit(c.name).alias("check_name"), F.col(f"n{i}").alias("violations")) for i, c in enumerate(same)]
        counted.append(totals.select(F.inline(F.array(*named))))
    return reduce(DataFrame.unionByName, counted)
