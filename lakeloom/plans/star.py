"""The warehouse over one folder of extracts: which tables there are and how each is built.

A table is built from the published tables before it, as the daily run does: silver from the raw
extracts, gold from silver, marts from gold. Within one application each is built and published
once, in the shared folder, and every later reader starts from its files. That cuts the lineage
for lost executors and gives Catalyst true sizes to choose broadcast joins by.
"""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from lakeloom.functions.constants import GOLD_ABOVE, SILVER_FROM
from lakeloom.operators.history import history_from_snapshots
from lakeloom.plans import dimensions, facts, marts, quarantine, silver
from lakeloom.session import shared_folder
from lakeloom.sources import tables
from lakeloom.sources.bronze import BronzeDay
from lakeloom.sources.standins import Extracts


@dataclass(frozen=True)
class Rules:
    """Business parameters that depend on the data at hand."""

    calendar: tuple[date, date] = (date(2016, 1, 1), date(2020, 12, 31))
    snapshot_dates: tuple[date, ...] = (date(2018, 9, 1),)
    silver_from: int = SILVER_FROM
    gold_above: int = GOLD_ABOVE

    @property
    def segments(self) -> dict[str, int]:
        return {"silver_from": self.silver_from, "gold_above": self.gold_above}


# What fits the given tables: their years, and thresholds that fill all three segments.
GIVEN_TABLES = Rules(
    calendar=(date(1995, 1, 1), date(2002, 12, 31)),
    snapshot_dates=tuple(date(year, 1, 1) for year in range(1997, 2002)),
    silver_from=4_500_000,
    gold_above=5_200_000,
)


@dataclass(frozen=True)
class TableSpec:
    """One table: its layer, its key and the plan that builds it from others."""

    layer: str
    primary_key: Sequence[str]
    build: Callable[[Star], DataFrame]


class Star:
    """Published tables by name (``star.fct_orders``), raw extracts under ``star.raw``.

    ``raw`` has one attribute per source: the bronze tables of a day, or the given tables in
    their shape.
    """

    def __init__(self, raw: Extracts | BronzeDay, rules: Rules, root: str | None = None):
        self.spark: SparkSession = raw.spark
        self.raw = raw
        self.rules = rules
        self._root = root
        self._read: dict[str, DataFrame] = {}
        self._staged: dict[str, str] = {}
        self._building = {name: threading.RLock() for name in TABLES}

    @property
    def root(self) -> str:
        """Where this warehouse lives: one place per application, input folder and set of rules."""
        if self._root is None:
            identity = hashlib.sha256(f"{self.raw.folder}|{self.rules}".encode()).hexdigest()[:16]
            application = self.spark.sparkContext.applicationId
            self._root = f"{shared_folder(self.spark)}/warehouse-{application}/{identity}"
        return self._root

    def plan(self, name: str) -> DataFrame:
        """How the table is built, not yet run."""
        return TABLES[name].build(self)

    def publish(self, name: str) -> int:
        """Build, check and publish the table; returns its rows."""
        spec = TABLES[name]
        self._read.pop(name, None)
        return tables.publish(self.plan(name), f"{self.root}/{spec.layer}", name, spec.primary_key)

    def stage(self, name: str) -> int:
        """Build and check the table without letting others see it; this object reads it from now on."""
        spec = TABLES[name]
        folder, rows = tables.stage(self.plan(name), f"{self.root}/{spec.layer}", name, spec.primary_key)
        self._staged[name] = folder
        self._read[name] = tables.read_staged(self.spark, folder)
        return rows

    def release(self) -> None:
        """Let readers see all that was staged, dimensions before the facts that point at them."""
        for folder in self._staged.values():
            tables.release(self.spark, folder)
        self._staged.clear()

    def discard(self) -> None:
        """Go back to the published versions of all that was staged."""
        for name in self._staged:
            self.forget(name)
        self._staged.clear()

    def forget(self, name: str) -> None:
        """Read the table anew next time, as it was published elsewhere."""
        self._read.pop(name, None)

    def table(self, name: str) -> DataFrame:
        """The published table, built first where that has not happened yet."""
        # Of two threads that ask for it one builds it. Tables are built of earlier ones only, so nobody waits in a circle.
        with self._building[name]:
            if name not in self._read:
                layer = f"{self.root}/{TABLES[name].layer}"
                if not tables.table_exists(self.spark, layer, name):
                    self.publish(name)
                self._read[name] = tables.read_table(self.spark, layer, name)
            return self._read[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.table(name)

    def seller_snapshot(self, as_of: date) -> DataFrame:
        """State and segment of every seller at one date."""
        return dimensions.seller_snapshot(self.sellers, self.order_items, self.orders, as_of, **self.rules.segments)


def _seller_snapshots(star: Star) -> DataFrame:
    return dimensions.seller_snapshots(
        star.sellers, star.order_items, star.orders, star.rules.snapshot_dates, **star.rules.segments
    )


def _dim_seller(star: Star) -> DataFrame:
    first = min(star.rules.snapshot_dates)
    return history_from_snapshots(star.seller_snapshots, dimensions.SELLER_HISTORY, first)


_SILVER = {
    "customers": lambda s: silver.customers(s.raw.customers, s.raw.orders),
    "sellers": lambda s: silver.sellers(s.raw.sellers),
    "products": lambda s: silver.products(s.raw.products, s.raw.categories),
    "geolocation": lambda s: silver.geolocation(s.raw.geolocation),
    "orders": lambda s: silver.orders(s.raw.orders, s.raw.customers),
    "order_items": lambda s: silver.order_items(s.raw.order_items),
    "payments": lambda s: silver.payments(s.raw.payments),
    "reviews": lambda s: silver.reviews(s.raw.reviews),
}
_QUARANTINE = {f"quarantine_{entity}": lambda s, entity=entity: quarantine.quarantine(s, entity) for entity in quarantine.RULES}
_GOLD = {
    "dim_date": lambda s: dimensions.dim_date(s.orders, s.reviews, s.rules.calendar),
    "dim_customer": lambda s: dimensions.dim_customer(s.customers, s.orders),
    "dim_product": lambda s: dimensions.dim_product(s.products),
    "dim_geography": lambda s: dimensions.dim_geography(s.geolocation),
    "seller_snapshots": _seller_snapshots,
    "dim_seller": _dim_seller,
    "fct_orders": lambda s: facts.fct_orders(s.orders, s.order_items, s.dim_customer, s.dim_geography),
    "fct_order_items": lambda s: facts.fct_order_items(s.order_items, s.fct_orders, s.dim_product, s.dim_seller),
    "fct_payments": lambda s: facts.fct_payments(s.payments, s.fct_orders),
    "fct_reviews": lambda s: facts.fct_reviews(s.reviews, s.fct_orders),
}
_MARTS = {
    "mart_cohortes": lambda s: marts.mart_cohortes(s.fct_orders, s.dim_customer, s.dim_date),
    "mart_satisfaccion": lambda s: marts.mart_satisfaccion(s.fct_orders, s.fct_reviews, s.dim_date),
    "mart_ventas_categoria": lambda s: marts.mart_ventas_categoria(s.fct_order_items, s.dim_product, s.dim_date),
    "mart_segmento_vendedor": lambda s: marts.mart_segmento_vendedor(s.fct_order_items, s.dim_seller, s.dim_date),
}
_KEYS = {
    **silver.PRIMARY_KEYS,
    **dimensions.PRIMARY_KEYS,
    "seller_snapshots": ["as_of", "seller_id"],
    **facts.PRIMARY_KEYS,
    **marts.PRIMARY_KEYS,
    **{name: ["quarantine_id"] for name in _QUARANTINE},
}

# In build order: within a layer dimensions come before facts, layers one after the other.
TABLES = {
    name: TableSpec(layer, _KEYS[name], build)
    for layer, builds in (("silver", _SILVER), ("quarantine", _QUARANTINE), ("gold", _GOLD), ("marts", _MARTS))
    for name, build in builds.items()
}


def names_of(layer: str) -> list[str]:
    return [name for name, spec in TABLES.items() if spec.layer == layer]
