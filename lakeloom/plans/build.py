"""Layer builds, persisted history loads and the daily run that joins them."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.history import HistorySpec, changed, first_load, merge_counts, merge_snapshot
from lakeloom.plans import contracts
from lakeloom.plans.dimensions import SELLER_HISTORY
from lakeloom.plans.star import TABLES, Star, names_of
from lakeloom.sources import jdbc, tables

log = logging.getLogger("lakeloom")

# A rebuild would take loaded versions, and with them the keys that facts point at, away.
KEEPS_PAST = ("seller_snapshots", "dim_seller")


class GateClosed(ValueError):
    """Checks failed before a layer was released; readers stay on the last good versions."""


def build_layer(star: Star, layer: str, build: Callable[[Star, str], int] = Star.publish) -> dict[str, int]:
    """Publish (or ``Star.stage``) every table of a layer in order and return its rows; the first failure ends it.

    Bad data (``ValueError``: key, schema, missing input) is told apart from technical trouble. A table
    that keeps the past is built here only where there is none yet; from then on it is loaded.
    """
    written: dict[str, int] = {}
    for name in names_of(layer):
        started = time.monotonic()
        if name in KEEPS_PAST and tables.table_exists(star.spark, f"{star.root}/{layer}", name):
            continue
        try:
            written[name] = build(star, name)
        except ValueError:
            log.exception("%s.%s rejected: its data breaks a rule", layer, name)
            raise
        except Exception:
            log.exception("%s.%s failed for a technical reason", layer, name)
            raise
        log.info("%s.%s: %d rows in %.1f s", layer, name, written[name], time.monotonic() - started)
    return written


def gated_layer(star: Star, layer: str) -> dict[str, int]:
    """Stage a layer, check it as a whole, and only then let readers see it.

    A broken rule or any failure leaves all tables of the layer as they were published. The tables become visible
    one after the other, dimensions first.
    """
    try:
        done = build_layer(star, layer, Star.stage)
        if found := contracts.broken(star, layer):
            raise GateClosed(f"{layer}: " + ", ".join(f"{name} ({n})" for name, n in sorted(found.items())))
    except Exception:
        star.discard()
        raise
    star.release()
    return done


def run_day(star: Star, day: date) -> dict[str, int]:
    """One daily run: silver of that day and its quarantine, the seller history up to it, gold, marts.

    Returns rows by table. A broken rule of gold ends the run before readers see any of its facts and dimensions; one of
    the marts leaves these as they were. What broke a rule of its entity is in the quarantine either way.
    """
    done = build_layer(star, "silver") | build_layer(star, "quarantine")
    done["dim_seller"] = load_sellers(star, day)["inserted"]
    return done | gated_layer(star, "gold") | gated_layer(star, "marts")


def retire_layers(star: Star, keep: int = 2) -> dict[str, list[int]]:
    """Delete old versions of every table, to be called when no job reads them any more; returns what went by table."""
    gone = {name: tables.retire(star.spark, f"{star.root}/{spec.layer}", name, keep) for name, spec in TABLES.items()}
    return {name: versions for name, versions in gone.items() if versions}


def load_sellers(star: Star, day: date) -> dict[str, int]:
    """Bring the published sellers up to a day, from the silver tables as they are now."""
    root = f"{star.root}/{TABLES['dim_seller'].layer}"
    counts = load_history(root, "dim_seller", star.seller_snapshot(day), SELLER_HISTORY, day)
    star.forget("dim_seller")
    return counts


def serve(star: Star, url: str, schema: str, properties: dict[str, str], connections: int = 8) -> dict[str, int]:
    """Copy dimensions and facts to a serving database, table by table; returns rows written."""
    served = [name for name in names_of("gold") if name.startswith(("dim_", "fct_"))]
    return {name: jdbc.copy_to_jdbc(star.table(name), url, f"{schema}.{name}", properties, connections) for name in served}


def _differences(current: DataFrame, snapshot: DataFrame, spec: HistorySpec) -> DataFrame:
    same = F.col(f"new.{spec.natural}") == F.col(f"cur.{spec.natural}")
    joined = snapshot.alias("new").join(current.where("is_current").alias("cur"), same, "left")
    return joined.where(F.col(f"cur.{spec.natural}").isNull() | changed(spec, "new", "cur"))


def load_history(root: str, table: str, snapshot: DataFrame, spec: HistorySpec, as_of: date) -> dict[str, int]:
    """Bring a published type-2 table up to ``as_of`` and say what changed.

    Repeating a load changes nothing. A load older than the latest one that would change
    something is refused, as it would write validity ranges that end before they begin.
    """
    spark = snapshot.sparkSession
    key = [spec.surrogate]
    if not tables.table_exists(spark, root, table):
        rows = tables.publish(first_load(snapshot, spec), root, table, key)
        return {"inserted": rows, "closed": 0, "changed_detected": 0}
    history = tables.read_table(spark, root, table)
    latest = history.agg(F.max("valid_from")).first()[0]
    if as_of <= latest:
        if not _differences(history, snapshot, spec).isEmpty():
            raise ValueError(f"{table} already holds versions of {latest}; {as_of} would rewrite the past")
        return {"inserted": 0, "closed": 0, "changed_detected": 0}
    if _differences(history, snapshot, spec).isEmpty():
        return {"inserted": 0, "closed": 0, "changed_detected": 0}
    tables.publish(merge_snapshot(history, snapshot, spec, as_of), root, table, key)
    return tables.read_table(spark, root, table).agg(*merge_counts(as_of)).first().asDict()
