"""Hot keys, hot NULLs and plan shapes that have to hold at any size."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import date, datetime
import re

import pytest
from pyspark.sql import functions as F

from lakeloom.operators.dimension import point_in_time, point_in_time_by_period
from lakeloom.operators.grouping import latest_per_key, mode_per_key, one_per_key
from lakeloom.operators.incremental import upsert
from lakeloom.plans import facts
from tests.conftest import plan_text

ROWS = 200_000


@contextmanager
def settings(spark, **values):
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def large(spark):
    """Settings under which small data behaves like large: no broadcast, early skew splits."""
    return settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="200KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__coalescePartitions__parallelismFirst="false",
    )


def final_plan(df) -> str:
    """Plan after a run, with what adaptive execution made of it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hot_orders(spark):
    """A third of the orders belongs to one customer, a third to nobody known."""
    key = F.col("id")
    owner = F.when(key % 3 == 0, "hot").when(key % 3 == 1, F.lit(None)).otherwise((key % 5000).cast("string"))
    return spark.range(0, ROWS, numPartitions=8).select(
        key.cast("string").alias("order_id"),
        owner.alias("customer_unique_id"),
        F.lit(datetime(2020, 1, 1)).alias("order_purchase_timestamp"),
    )


@pytest.fixture(scope="module")
def dimensions(spark):
    """Customers, the hot one among them, and the one place they live in."""
    key = F.col("id").cast("string")
    known = spark.range(5000).select(key.alias("customer_unique_id")).unionByName(
        spark.range(1).select(F.lit("hot").alias("customer_unique_id"))
    )
    people = known.select(
        "customer_unique_id", F.sha2("customer_unique_id", 256).alias("customer_sk"), F.lit("01000").alias("customer_zip_code_prefix")
    )
    places = spark.range(1).select(F.lit("01000").alias("zip_code_prefix"), F.lit("place").alias("geography_sk"))
    return people, places


def test_lookup_splits_a_hot_key_and_keeps_every_row(spark, hot_orders, dimensions):
    moments = ["order_delivered_customer_date", "order_estimated_delivery_date"]
    orders = hot_orders.withColumns({c: F.lit(None).cast("timestamp") for c in moments} | {"order_status": F.lit("SHIPPED")})
    items = spark.range(ROWS).select(
        F.col("id").cast("string").alias("order_id"), *[F.lit(1).cast("decimal(12,2)").alias(c) for c in ("price", "freight_value")]
    )
    with large(spark):
        fact = facts.fct_orders(orders, items, *dimensions).select("order_id", "customer_sk", "geography_sk")
        assert "skew=true" in final_plan(fact)
        counted = dict(fact.groupBy(F.col("customer_sk") == "-1").count().collect())
        assert fact.where("(customer_sk = '-1') <> (geography_sk = '-1')").isEmpty()
    unknown = hot_orders.where("customer_unique_id is null").count()
    assert counted == {True: unknown, False: ROWS - unknown}


def test_point_in_time_splits_a_hot_seller(spark):
    sales = spark.range(0, ROWS, numPartitions=8).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 1000).cast("string")).alias("seller_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 700).cast("int")).alias("on_day"),
        F.sha2(F.col("id").cast("string"), 256).alias("filler"),
    )
    sellers = spark.range(1000).select(F.col("id").cast("string").alias("seller_id")).union(
        spark.range(1).select(F.lit("hot"))
    )
    halves = [("1900-01-01", "2020-12-31"), ("2021-01-01", "9999-12-31")]
    history = sellers.select(
        "seller_id",
        F.explode(F.array(*[F.struct(*[F.lit(d).cast("date").alias(n) for n, d in zip(("valid_from", "valid_to"), h)]) for h in halves])).alias("v"),
    ).select("seller_id", "v.*", F.concat_ws("|", "seller_id", "v.valid_from").alias("seller_sk"))
    with large(spark):
        joined = point_in_time(sales, history, "seller_id", "on_day", ["seller_sk"])
        assert "skew=true" in final_plan(joined.select("seller_sk", "filler"))
        assert joined.count() == ROWS
        assert joined.where("seller_sk is null").isEmpty()


def test_a_sale_meets_the_versions_of_its_period_only(spark):
    """A seller of 1,000 versions costs a sale no more candidates than one of a few."""
    day = F.date_add(F.lit(date(2000, 1, 1)), F.col("id").cast("int") * 4)
    busy = spark.range(1000).select(F.lit("busy").alias("s"), F.when(F.col("id") == 0, F.lit(date(1900, 1, 1))).otherwise(day).alias("valid_from"),
        F.when(F.col("id") == 999, F.lit(date(9999, 12, 31))).otherwise(F.date_add(day, 3)).alias("valid_to"), F.col("id").alias("v"))
    calm = spark.range(1).select(F.lit("calm").alias("s"), F.lit(date(1900, 1, 1)).alias("valid_from"), F.lit(date(9999, 12, 31)).alias("valid_to"), F.lit(-1).cast("long").alias("v"))
    history = busy.unionByName(calm)
    sales = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, "busy").when(F.col("id") % 3 == 0, "calm").alias("s"),
        F.date_add(F.lit(date(1990, 1, 1)), (F.col("id") % 9000).cast("int")).alias("day"),
    )
    found = point_in_time_by_period(sales, history, "s", "day", ["v"])
    plain = point_in_time(sales, history, "s", "day", ["v"])
    assert found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join LeftOuter, .*_period", text)
    cut = point_in_time_by_period(sales, history.withColumns({"valid_from": F.lit(date(1900, 1, 1)), "valid_to": F.lit(date(9999, 12, 31))}).where("v >= 998 or v < 0"), "s", "day", ["v"])
    assert cut.where("s = 'busy'").count() == 2 * sales.where("s = 'busy'").count()


@pytest.mark.parametrize("operator", ["latest", "one", "mode"])
def test_choices_per_key_reduce_before_the_shuffle(spark, hot_orders, operator):
    """A hot key reaches the shuffle as one row per map task and value, not as all its rows."""
    keyed = hot_orders.select(F.coalesce("customer_unique_id", F.lit("none")).alias("k"), "order_id", (F.length("order_id")).alias("size"))
    choose = {
        "latest": lambda: latest_per_key(keyed, ["k"], ["size", "order_id"], ["size"]),
        "one": lambda: one_per_key(keyed, ["k"]),
        "mode": lambda: mode_per_key(keyed, ["k"], ["size"]),
    }[operator]
    df = choose()
    text = plan_text(df)
    assert "Window" not in text
    partial = text.index("partial_")
    assert text.rindex("Exchange hashpartitioning(k", 0, partial) < partial  # printed from the result downwards
    assert df.count() == keyed.select("k").distinct().count()


def test_upsert_leaves_the_base_where_it_is(spark, tmp_path):
    base_path, change_path = f"{tmp_path}/base", f"{tmp_path}/changes"
    base = spark.range(ROWS).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.when(F.col("id") == 0, 2).otherwise(0).alias("at"))
    base.write.parquet(base_path)
    spark.range(101).select(F.when(F.col("id") == 100, ROWS).otherwise(F.col("id") * 7).alias("k"), F.lit("new").alias("v"), F.lit(1).alias("at")).write.parquet(change_path)
    result = upsert(spark.read.parquet(base_path), spark.read.parquet(change_path), ["k"], ["at"])
    # The base is read in whole once and once for its keys; no row of it is shuffled for a join.
    text = plan_text(result)
    assert len(re.findall(r"Location: InMemoryFileIndex.*?/base\]", text)) == 2
    executed = final_plan(result.agg(F.count("*"), F.count_if(F.col("v") == "new")))
    assert "BroadcastHashJoin" in executed and "SortMergeJoin" not in executed
    # One change is older than the base, another is of a key that the base lacks.
    assert result.count() == ROWS + 1 and result.where("v = 'new'").count() == 100
    assert [r.v for r in result.where("k = 0").collect()] == ["old"]


def test_marts_filter_unknown_members_before_the_join(star):
    """The unknown customer may hold a third of the facts: it never reaches the join."""
    text = star.plan("mart_cohortes")._jdf.queryExecution().optimizedPlan().toString()
    fact = [line for line in text.splitlines() if "Filter" in line and "purchase_date_sk" in line]
    assert any("NOT (customer_sk" in line and "= -1)" in line for line in fact)

