"""Quarantine of every entity: the raw rows that break a rule, with rule, error, source file and batch.

A row of an extract stands once for each rule that it breaks; equal rows stand once, with how often they came. Rules that
look rows up elsewhere do so by one left join on a key, so an extract is read once whatever the number of its rules.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.cleaning import clean_code, clean_text, to_double, to_int, to_money, to_timestamp
from lakeloom.functions.constants import STATES_BY_REGION
from lakeloom.operators.quality import split_quarantine

LATITUDES, SCORES = (-90.0, 90.0), (1, 5)
STATES = [state for states in STATES_BY_REGION.values() for state in states]
ADDED = ("rule_id", "error_text", "occurrences", "source_file", "batch_id")
AUDIT = {"source_file": "_source_file", "batch_id": "_batch_id"}


def _unreadable(name: str, read: Callable[[str], Column]) -> Column:
    """Something is there and cannot be read; a blank is no fault."""
    return (F.trim(F.col(name)) != "") & read(name).isNull()


@dataclass(frozen=True)
class Rule:
    error: str
    broken: Callable[[], Column]


@dataclass(frozen=True)
class Lookup:
    """A reference: ``column`` has to be among ``key`` of the extract or published table ``table``."""

    error: str
    column: str
    table: str
    key: str
    raw: bool = False


@dataclass(frozen=True)
class Rules:
    own: dict[str, Rule] = field(default_factory=dict)
    lookups: dict[str, Lookup] = field(default_factory=dict)


def _place(city: str, state: str) -> dict[str, Rule]:
    return {
        "city_missing": Rule("no city", lambda: clean_text(city).isNull()),
        "state_unknown": Rule("no such state", lambda: F.coalesce(~clean_code(state).isin(*STATES), F.lit(True))),
    }


RULES = {
    "customers": Rules(
        _place("customer_city", "customer_state"),
        {"order_missing": Lookup("no order of this customer id", "customer_id", "orders", "customer_id", raw=True)},
    ),
    "sellers": Rules(
        _place("seller_city", "seller_state"),
        {"never_sold": Lookup("no item of this seller", "seller_id", "order_items", "seller_id")},
    ),
    "products": Rules(
        {
            "category_missing": Rule("no category", lambda: clean_text("product_category_name").isNull()),
            "weight_unreadable": Rule("weight is not a number", lambda: _unreadable("product_weight_g", to_int)),
            "photos_missing": Rule("no number of photos", lambda: to_int("product_photos_qty").isNull()),
        }
    ),
    "geolocation": Rules(
        _place("geolocation_city", "geolocation_state")
        | {
            "latitude_missing": Rule("no latitude", lambda: to_double("geolocation_lat").isNull()),
            "off_the_map": Rule("latitude out of bounds", lambda: ~to_double("geolocation_lat").between(*LATITUDES)),
        }
    ),
    "orders": Rules(
        {
            "status_missing": Rule("no status", lambda: clean_code("order_status").isNull()),
            "purchase_missing": Rule("no moment of purchase", lambda: to_timestamp("order_purchase_timestamp").isNull()),
            "approval_unreadable": Rule("moment of approval cannot be read", lambda: _unreadable("order_approved_at", to_timestamp)),
        },
        {"customer_unknown": Lookup("no such customer", "customer_id", "customers", "customer_id", raw=True)},
    ),
    "order_items": Rules(
        {"freight_missing": Rule("freight is not a number", lambda: to_money("freight_value").isNull())},
        {
            "order_unknown": Lookup("no such order", "order_id", "orders", "order_id"),
            "product_unknown": Lookup("no such product", "product_id", "products", "product_id"),
            "seller_unknown": Lookup("no such seller", "seller_id", "sellers", "seller_id"),
        },
    ),
    "payments": Rules(
        {"installments_missing": Rule("no number of installments", lambda: to_int("payment_installments").isNull())},
        {"order_unknown": Lookup("no such order", "order_id", "orders", "order_id")},
    ),
    "reviews": Rules(
        {
            "score_out_of_range": Rule("score is not one to five", lambda: F.coalesce(~to_int("review_score").between(*SCORES), F.lit(True))),
            "answer_missing": Rule("no moment of the answer", lambda: to_timestamp("review_answer_timestamp").isNull()),
        },
        {"order_unknown": Lookup("no such order", "order_id", "orders", "order_id")},
    ),
}


def split(raw: DataFrame, entity: str, reference: Callable[[Lookup], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(rows that keep all rules, quarantine) of an extract; ``reference`` gives the table of a lookup."""
    rules = RULES[entity]
    columns = [c for c in raw.columns if c not in AUDIT.values() and c != "_ingested_at"]
    audit = {c: F.col(own) if own in raw.columns else F.lit(f"{entity}.csv" if c == "source_file" else "given") for c, own in AUDIT.items()}
    checked = raw
    for name, lookup in rules.lookups.items():
        known = reference(lookup).select(F.col(lookup.key).alias(f"_{name}_key")).distinct()
        checked = checked.join(known, F.col(lookup.column) == F.col(f"_{name}_key"), "left")
    conditions = {name: rule.broken() for name, rule in rules.own.items()}
    conditions |= {name: F.col(f"_{name}_key").isNull() for name in rules.lookups}
    errors = {name: rule.error for name, rule in (rules.own | rules.lookups).items()}
    good, bad = split_quarantine(checked, conditions, errors, audit)
    kinds = [*columns, "rule_id", "error_text", "source_file", "batch_id"]
    counted = bad.groupBy(*kinds).agg(F.count("*").alias("occurrences"))
    return good.select(*raw.columns), counted.select(*columns, *ADDED)


def keyed(quarantined: DataFrame) -> DataFrame:
    """The quarantine with a key: a digest of what its rows differ in."""
    parts = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in quarantined.columns if c != "occurrences"]
    return quarantined.select(F.sha2(F.concat(*parts), 256).alias("quarantine_id"), "*")


def quarantine(star, entity: str) -> DataFrame:
    """The quarantine of an entity of a warehouse, as it is published."""
    found = split(getattr(star.raw, entity), entity, lambda x: getattr(star.raw, x.table) if x.raw else star.table(x.table))
    return keyed(found[1])
