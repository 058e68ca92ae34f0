"""What building the warehouse moves and leaves behind on disk."""

from __future__ import annotations

import os
import re

from pyspark.sql import functions as F

from lakeloom.functions.keys import key_bytes, packed, unpacked
from lakeloom.operators.dimension import join_on_digest
from lakeloom.plans import facts, monthly
from lakeloom.session import INITIAL_PARTITIONS, SHUFFLE_CLEANUP, TASK_SIZES, at_once, short_shuffles, working_folder
from lakeloom.sources import tables
from tests.conftest import plan_text

SHA_OF_A = "ca978112ca1bbdcafac231b39a23dc4da786eff8147c4e72b9807785afee48bb"


def _folders(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    return {f for f in os.listdir(shared) if f.startswith(("monthly-", "change-set-"))} if os.path.isdir(shared) else set()


def test_tables_by_month_leave_no_second_copy(spark):
    before, root = _folders(spark), working_folder(spark, "by-month")
    rows = spark.range(100).select("id", (199801 + F.col("id") % 2).cast("int").alias(monthly.MONTH))
    monthly.replace_months(rows, root, "t")
    assert monthly.read(spark, root, "t").count() == 100
    # A change that reads what it replaces, and leaves a month without rows.
    kept = monthly.read(spark, root, "t", [199801, 199802]).where("id % 2 = 1")
    monthly.replace_months(kept, root, "t", [199801, 199802])
    assert {(r.id, r[monthly.MONTH]) for r in monthly.read(spark, root, "t").collect()} == {(n, 199802) for n in range(1, 100, 2)}
    assert _folders(spark) == before


def test_published_digests_are_compressed(spark):
    root = working_folder(spark, "codec")
    tables.publish(spark.range(10).select(F.sha2(F.col("id").cast("string"), 256).alias("k")), root, "t", ["k"])
    files = os.listdir(f"{root}/t/version=1")
    assert any(f.endswith(".zstd.parquet") for f in files)


def test_shuffle_files_of_a_write_go_with_it(spark):
    root, before = working_folder(spark, "short"), spark.conf.get(SHUFFLE_CLEANUP, None)
    held = spark.range(1000).repartition(7, "id")
    with short_shuffles(spark):
        held.write.parquet(root)
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before
    assert spark.read.parquet(root).count() == 1000


def test_products_are_looked_up_without_moving_their_digests(spark):
    """Keys by rule, keys of their own, repeated, unknown and NULL products."""
    products = spark.createDataFrame([("a", SHA_OF_A), ("own", "k1"), ("own", "k2"), ("Unknown", "-1"), (None, "none")], "product_id string, product_sk string")
    items = spark.createDataFrame(
        [("o1", n, p, "s", 1.0, 2.0) for n, p in enumerate(["a", "own", "Unknown", "gone", None])],
        "order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double",
    )
    orders = spark.createDataFrame([("o1", 20180101, "c", "g")], "order_id string, purchase_date_sk int, customer_sk string, geography_sk string")
    sellers = spark.sql("select 's' as seller_id, 'v' as seller_sk, date '1900-01-01' as valid_from, date '9999-12-31' as valid_to")
    fact = facts.fct_order_items(items, orders, products, sellers)
    found = sorted((r.order_item_id, r.product_sk) for r in fact.collect())
    assert found == [(0, SHA_OF_A), (1, "k1"), (1, "k2"), (2, "-1"), (3, "-1"), (4, "-1")]
    # The order, whose keys are wide, is joined after the product.
    plan = plan_text(fact).split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    joins = re.findall(r"Join LeftOuter, \((\w+)#", plan)
    assert joins[-1] == "product_id"


def test_order_meets_its_customer_last(star):
    fact = facts.fct_orders(star.orders, star.order_items, star.dim_customer, star.dim_geography)
    plan = plan_text(fact).split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert re.findall(r"Join LeftOuter, \((\w+)#", plan)[0] == "customer_unique_id"


def test_packed_keys_come_back_letter_by_letter(spark):
    """Digests, the unknown member, capitals, odd lengths, other texts, blanks and NULL."""
    keys = [SHA_OF_A, SHA_OF_A.upper(), SHA_OF_A[:-1], "-1", "ab", "AB", "a", "none", "", None]
    rows = spark.createDataFrame([(n, key) for n, key in enumerate(keys)], "n int, k_sk string")
    moved = packed(rows, "k_sk")
    assert moved.columns == ["n", "k_sk_bytes", "k_sk_text"]
    assert moved.where("n = 0 and length(k_sk_bytes) = 32 and k_sk_text is null").count() == 1
    back = unpacked(moved, "k_sk")
    assert back.columns == ["n", "k_sk"] and [r.k_sk for r in back.orderBy("n").collect()] == keys


def test_no_digest_of_an_order_or_seller_moves_as_text(star):
    """What is shuffled to meet an item, and what is dealt out by month, holds no key as hexadecimal text."""
    fact = facts.fct_order_items(star.order_items, star.fct_orders, star.dim_product, star.dim_seller)
    plan = plan_text(fact).split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    below = plan[plan.index("Join") :]
    assert "customer_sk_bytes" in below and "seller_sk_bytes" in below
    assert not re.search(r"lower\(hex\((customer|geography|seller)_sk_bytes", below)


def test_tasks_of_a_write_are_bounded_unless_the_session_says_otherwise(spark):
    key, least = INITIAL_PARTITIONS
    own, other = TASK_SIZES
    before = [spark.conf.get(name, None) for name in (key, own, other)]
    spark.conf.set(own, "5m")
    try:
        with short_shuffles(spark):
            assert int(spark.conf.get(key)) >= least
            assert (spark.conf.get(own), spark.conf.get(other)) == ("5m", TASK_SIZES[other])
        assert [spark.conf.get(name, None) for name in (key, own, other)] == [before[0], "5m", before[2]]
    finally:
        spark.conf.unset(own)


def test_months_are_dealt_out_with_packed_keys(spark):
    keys = [SHA_OF_A, "-1", "AB", None]
    rows = spark.createDataFrame([(n, key, 199801) for n, key in enumerate(keys)], f"n int, k_sk string, {monthly.MONTH} int")
    dealt = monthly._dealt(rows)
    assert dealt.columns == rows.columns and sorted(dealt.collect(), key=lambda r: r.n) == rows.collect()
    plan = plan_text(dealt).split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert "k_sk_bytes" in plan[plan.index("RepartitionByExpression") :]


def test_items_are_dealt_out_by_month_without_digests_of_products(spark, star, monkeypatch):
    """The first load moves ids of products, and ends with the rows of the fact."""
    root, dealt = working_folder(spark, "narrow"), {}
    deal = monthly._dealt

    def watched(rows):
        dealt[len(dealt)] = rows.columns
        return deal(rows)

    monkeypatch.setattr(monthly, "_dealt", watched)
    monthly.first_load(star, root)
    of_items = [columns for columns in dealt.values() if "seller_sk_bytes" in columns]
    assert len(of_items) == 1 and "product_id" in of_items[0] and "product_sk" not in of_items[0]
    found = monthly.read(spark, root, "fct_order_items")
    assert found.columns == [*facts.CONTRACTS["fct_order_items"], monthly.MONTH]
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(found.drop(monthly.MONTH)) == rows(star.fct_order_items)


def test_items_move_for_their_order_only(spark):
    """Neither products nor sellers are few enough to be broadcast; their keys follow from ids and dates all the same."""
    products = spark.range(20_000).selectExpr("cast(id as string) as product_id", "sha2(cast(id as string), 256) as product_sk")
    items = spark.range(2_000).selectExpr(
        "cast(id div 3 as string) as order_id", "cast(id % 3 as int) as order_item_id", "cast(id as string) as product_id",
        "'s' as seller_id", "1.0d as price", "2.0d as freight_value",
    )
    orders = spark.range(1_000).selectExpr("cast(id as string) as order_id", "20180101 as purchase_date_sk", "'c' as customer_sk", "'g' as geography_sk")
    sellers = spark.sql("select 's' as seller_id, sha2('s|1900-01-01', 256) as seller_sk, date '1900-01-01' as valid_from, date '9999-12-31' as valid_to")
    root, held = working_folder(spark, "moved"), {}
    for name, df in {"products": products, "items": items, "orders": orders, "sellers": sellers}.items():
        df.write.parquet(f"{root}/{name}")
        held[name] = spark.read.parquet(f"{root}/{name}")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "3k")
    try:
        fact = facts.fct_order_items(held["items"], held["orders"], held["products"], held["sellers"])
        physical = plan_text(fact).split("== Physical Plan ==")[1]
        rows = fact.where("product_sk = sha2(cast(cast(order_id as int) * 3 + order_item_id as string), 256)")
        assert (rows.count(), fact.select("seller_sk").distinct().count()) == (2_000, 1)
    finally:
        spark.conf.set(key, before)
    assert "hashpartitioning(order_id" in physical and "hashpartitioning(product_id" not in physical


def test_versions_keep_keys_of_their_own(spark):
    """Keys by rule, keys of their own, two rows of one period, and sellers or days without a version."""
    products = spark.createDataFrame([("a", SHA_OF_A)], "product_id string, product_sk string")
    items = spark.createDataFrame(
        [(o, n, "a", s, 1.0, 2.0) for n, (o, s) in enumerate([("o1", "rule"), ("o1", "own"), ("o1", "twice"), ("o1", "gone"), ("o1", None), ("o2", "rule")])],
        "order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double",
    )
    orders = spark.createDataFrame([("o1", 20180101, "c", "g")], "order_id string, purchase_date_sk int, customer_sk string, geography_sk string")
    sellers = spark.sql(
        """select seller_id, seller_sk, date '1900-01-01' as valid_from, date '9999-12-31' as valid_to from values
           ('rule', sha2('rule|1900-01-01', 256)), ('own', 'v'), ('twice', 'v1'), ('twice', 'v2') as t(seller_id, seller_sk)"""
    )
    rule = spark.sql("select sha2('rule|1900-01-01', 256)").first()[0]
    found = facts.fct_order_items(items, orders, products, sellers).select("order_item_id", "seller_sk").collect()
    assert sorted(map(tuple, found)) == [(0, rule), (1, "v"), (2, "v1"), (2, "v2"), (3, "-1"), (4, "-1"), (5, "-1")]


def test_joins_on_digests_move_their_bytes(spark):
    """Only equal keys meet: digests, the same in capitals, other texts and NULL."""
    keys = [SHA_OF_A, SHA_OF_A.upper(), "-1", "ab", "AB", "", None]
    rows = spark.createDataFrame([(n, key) for n, key in enumerate(keys)], "n int, k_sk string")
    met = join_on_digest(rows, rows.withColumnRenamed("n", "m"), "k_sk")
    assert sorted(map(tuple, met.collect())) == [(n, n) for n in range(6)] and met.columns == ["n", "m"]
    assert rows.select(key_bytes("k_sk").alias("b")).where("length(b) = 33").count() == 1


def test_a_month_is_written_in_the_order_it_is_dealt_out_in(spark, star):
    """Narrow rows are put in order of their months once; the write of wide ones does not sort them again."""
    items = facts.items_with_keys(star.order_items, star.fct_orders, star.dim_product, star.dim_seller)
    dealt = monthly._dealt(items.withColumn(monthly.MONTH, monthly.month_of(F.coalesce("date_sk", F.lit(-1)))))
    root = working_folder(spark, "ordered")
    facts.items_contracted(dealt, monthly.MONTH).createOrReplaceTempView("ended")
    spark.sql(f"create table ordered using parquet location '{root}' partitioned by ({monthly.MONTH}) as select * from ended where false")
    try:
        text = spark.sql("explain extended insert overwrite table ordered select * from ended").first()[0]
    finally:
        spark.sql("drop table ordered")
    written = text.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert "RepartitionByExpression" in written
    assert written.count(f"Sort [{monthly.MONTH}#") == 1 and written.index("sha2") < written.index("Sort [")


def test_rows_of_an_order_share_a_file(spark):
    rows = spark.range(3_000).selectExpr("cast(id div 3 as string) as order_id", "id as n", f"199801 as {monthly.MONTH}")
    lone = spark.range(3_000).selectExpr("cast(null as string) as order_id", "id as n", f"-1 as {monthly.MONTH}")
    root = working_folder(spark, "together")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        monthly.replace_months(rows.unionByName(lone).repartition(5, "n"), root, "t")
    finally:
        spark.conf.set(key, before)
    held = monthly.read(spark, root, "t").withColumn("f", F.input_file_name())
    assert held.where("order_id is not null").groupBy("order_id").agg(F.count_distinct("f").alias("k")).where("k > 1").isEmpty()
    # Rows without an order are spread all the same.
    assert held.where("order_id is null").select("f").distinct().count() > 1


def test_steps_at_once_end_together_and_raise(spark):
    seen = []
    assert at_once(spark, lambda: spark.range(3).count(), lambda: spark.range(5).count()) == [3, 5]
    before = spark.conf.get(SHUFFLE_CLEANUP, None)

    def fails():
        raise ValueError("no")

    try:
        at_once(spark, fails, lambda: seen.append(spark.range(7).count()))
    except ValueError as error:
        seen.append(str(error))
    assert seen == [7, "no"] and spark.conf.get(SHUFFLE_CLEANUP, None) == before
