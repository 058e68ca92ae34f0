"""The daily run: history is kept, facts point at it, a broken rule stops the marts."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from lakeloom.plans import build, contracts, quarantine
from lakeloom.plans.star import GIVEN_TABLES, TABLES, Star, names_of
from lakeloom.sources import tables


class Day:
    """The extracts of a day on which some sellers have moved."""

    def __init__(self, raw, ending: str):
        self._raw, self._ending = raw, ending
        self.spark, self.folder = raw.spark, f"{raw.folder}#{ending}"

    def __getattr__(self, name):
        found = getattr(self._raw, name)
        if name != "sellers":
            return found
        moved = F.when(F.col("seller_id").endswith(self._ending), "elsewhere").otherwise(F.col("seller_city"))
        return found.withColumn("seller_city", moved)


@pytest.fixture(scope="module")
def days(spark, star, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("daily"))
    first, second = (Star(Day(star.raw, ending), GIVEN_TABLES, root) for ending in ("1", "2"))
    build.run_day(first, date(1999, 1, 1))
    done = build.run_day(second, date(2000, 1, 1))
    return second, done


def test_history_survives_a_rebuild(days):
    star, done = days
    before = sorted(star.dim_seller.collect())
    assert done["dim_seller"] > 0 and not star.dim_seller.where("not is_current").isEmpty()
    assert star.dim_seller.where("seller_city = 'elsewhere' and is_current and seller_id like '%2'").count() > 0
    build.build_layer(star, "gold")
    star.forget("dim_seller")
    assert sorted(star.dim_seller.collect()) == before


def test_every_item_points_at_a_version(days):
    star, _ = days
    items = star.fct_order_items
    assert items.join(star.dim_seller, "seller_sk", "left_anti").isEmpty()
    early = items.where("date_sk between 19980101 and 19981231").join(star.dim_seller, "seller_sk")
    assert early.where("valid_from > date '1998-12-31'").isEmpty()


def test_a_repeated_day_writes_nothing(days):
    star, _ = days
    versions = lambda: tables.read_table(star.spark, f"{star.root}/gold", "dim_seller").inputFiles()
    before = versions()
    assert build.load_sellers(star, date(2000, 1, 1))["inserted"] == 0 and versions() == before


def _files(star, layer, *names):
    return [tables.read_table(star.spark, f"{star.root}/{layer}", name).inputFiles() for name in names]


def test_a_lost_order_leaves_readers_on_the_facts_they_had(days, monkeypatch):
    star, _ = days
    names = [name for name in names_of("gold") if name not in build.KEEPS_PAST]
    before = _files(star, "gold", *names), _files(star, "marts", "mart_cohortes")
    spec = TABLES["fct_orders"]
    losing = replace(spec, build=lambda s: spec.build(s).where("order_status <> 'DELIVERED'"))
    monkeypatch.setitem(TABLES, "fct_orders", losing)
    with pytest.raises(build.GateClosed, match="delivered orders are there"):
        build.run_day(star, date(2000, 1, 1))
    assert (_files(star, "gold", *names), _files(star, "marts", "mart_cohortes")) == before
    assert star.fct_orders.where("order_status = 'DELIVERED'").count() > 0
    monkeypatch.undo()
    build.gated_layer(star, "gold")
    assert all(x != y for x, y in zip(_files(star, "gold", *names), before[0], strict=True))


def test_a_failure_in_the_middle_releases_nothing(days, monkeypatch):
    star, _ = days
    before = _files(star, "gold", "dim_date", "fct_orders")
    spec = TABLES["fct_payments"]
    monkeypatch.setitem(TABLES, "fct_payments", replace(spec, primary_key=["order_id"]))
    with pytest.raises(tables.KeyViolation):
        build.gated_layer(star, "gold")
    assert _files(star, "gold", "dim_date", "fct_orders") == before


def test_declared_checks_are_the_gates(days):
    star, _ = days
    gates = [check.name for layer in ("gold", "marts") for check in contracts.gate_checks(layer)]
    assert sorted([*(check.name for check in contracts.declared_checks()), "delivered orders are there"]) == sorted(gates)
    assert contracts.broken(star, "gold") == {} and contracts.broken(star, "marts") == {}


def test_every_fault_is_in_quarantine_once(spark, star):
    """Rows of every entity with faults put in, one equal pair among them."""
    raw = star.raw.order_items
    faulty = raw.limit(1).withColumns({"freight_value": F.lit("?"), "seller_id": F.lit("nobody")})
    rows = raw.where("false").unionByName(faulty).unionByName(faulty)
    good, bad = quarantine.split(rows, "order_items", lambda x: star.table(x.table))
    found = {(r.rule_id, r.error_text, r.occurrences, r.source_file, r.batch_id) for r in bad.collect()}
    assert found == {
        ("freight_missing", "freight is not a number", 2, "order_items.csv", "given"),
        ("seller_unknown", "no such seller", 2, "order_items.csv", "given"),
    }
    assert good.isEmpty() and good.columns == raw.columns
    audited = rows.withColumns({"_source_file": F.lit("part-1.csv"), "_batch_id": F.lit("b1"), "_ingested_at": F.lit(None).cast("timestamp")})
    _, bad = quarantine.split(audited, "order_items", lambda x: star.table(x.table))
    assert {(r.source_file, r.batch_id) for r in bad.collect()} == {("part-1.csv", "b1")}
    places = spark.createDataFrame([("s1", "1", " ", "sp"), ("s2", "1", "x", "zz"), ("s3", "1", "x", None)], "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string")
    _, bad = quarantine.split(places, "sellers", lambda x: star.table(x.table))
    assert {(r.seller_id, r.rule_id) for r in bad.where("rule_id <> 'never_sold'").collect()} == {("s1", "city_missing"), ("s2", "state_unknown"), ("s3", "state_unknown")}
    assert quarantine.keyed(bad).select("quarantine_id").distinct().count() == bad.count()


def test_checks_of_one_subject_are_counted_apart(spark):
    class Faulty:
        def table(self, name):
            if name == "fct_orders":
                return spark.createDataFrame([(x,) for x in ("a", "a", "b", None, None, None)], "order_id string")
            rows = [(None, "Gold", 1), ("2018-01", None, None), ("2018-01", "Odd", 2), ("2018-02", "Odd", None)]
            return spark.createDataFrame(rows, "year_month string, seller_segment string, gmv int")

    own = [c for c in contracts.declared_checks() if "fct_orders.order_id" in c.name or "mart_segmento_vendedor" in c.name]
    assert len({c.subject for c in own}) == 3
    assert {r.check_name: r.violations for r in contracts.check_report(Faulty(), own).collect()} == {
        "unique fct_orders.order_id": 2,
        "not_null fct_orders.order_id": 3,
        "not_null mart_segmento_vendedor.year_month": 1,
        "not_null mart_segmento_vendedor.seller_segment": 1,
        "not_null mart_segmento_vendedor.gmv": 2,
        "accepted_values mart_segmento_vendedor.seller_segment": 1,
    }


def test_declared_checks_read_a_subject_once():
    checks = contracts.declared_checks()
    assert len(checks) == 33 and len({c.subject for c in checks}) == 19
