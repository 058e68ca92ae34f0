"""Tables by month: change sets touch their months only and end where a rebuild does."""

from __future__ import annotations

import os
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from lakeloom.plans import dimensions, facts, marts, monthly
from lakeloom.session import working_folder
from tests.conftest import plan_text


@pytest.fixture()
def root(spark, star):
    folder = working_folder(spark, "monthly-test")
    monthly.first_load(star, folder)
    return folder


def files(root, table):
    """Files by month, with their names, which no other write has."""
    top = f"{root}/{table}"
    months = [d for d in os.listdir(top) if d.startswith(monthly.MONTH)]
    return {int(d.split("=")[1]): sorted(f for f in os.listdir(f"{top}/{d}") if f.endswith("parquet")) for d in months}


class Later:
    """The warehouse with some tables in another state."""

    def __init__(self, star, **tables):
        self._star = star
        self.__dict__.update(tables)

    def __getattr__(self, name):
        return getattr(self._star, name)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_three_change_sets_equal_a_rebuild(spark, star, root):
    orders, items = star.orders, star.order_items
    sizes = monthly.with_month(orders).where("purchase_month > 0").groupBy("purchase_month").count().orderBy("purchase_month").collect()
    first, second, third = (r.purchase_month for r in sizes[3:6])
    of_month = lambda m: monthly.with_month(orders).where(F.col(monthly.MONTH) == m).drop(monthly.MONTH)
    again = F.concat("order_id", F.lit("-new")).alias("order_id")
    sets = [
        (of_month(first).withColumn("order_status", F.lit("DELIVERED")), items.withColumn("price", (F.col("price") * 2).cast("decimal(12,2)"))),
        # Orders that have lost their items, and new ones.
        (of_month(second), items.where("false")),
        (of_month(third).select(again, *orders.columns[1:]), items.select(again, *items.columns[1:])),
    ]
    for (changed, new), month in zip(sets, (first, second, third), strict=True):
        before = {table: files(root, table) for table in monthly.BY_PURCHASE}
        assert monthly.apply_changes(star, root, changed, new) == [month]
        for table in monthly.BY_PURCHASE:
            after = files(root, table)
            assert {m: f for m, f in after.items() if m != month} == {m: f for m, f in before[table].items() if m != month}
            # A month of few orders may be without reviews before and after.
            assert after.get(month) != before[table].get(month) or table in ("reviews", "fct_reviews", "mart_satisfaccion")
    # A month without any item has no sales left.
    assert second not in files(root, "fct_order_items") and second in files(root, "fct_orders")

    now_orders, now_items = orders, items
    for changed, new in sets:
        ids = changed.select("order_id")
        now_orders = now_orders.join(ids, "order_id", "left_anti").unionByName(changed)
        now_items = now_items.join(ids, "order_id", "left_anti").unionByName(new.join(ids, "order_id", "left_semi"))
    rebuilt = facts.fct_orders(now_orders, now_items, star.dim_customer, star.dim_geography)
    sales = facts.fct_order_items(now_items, rebuilt, star.dim_product, star.dim_seller)
    read = lambda name: monthly.read(spark, root, name).drop(monthly.MONTH)
    assert rows(read("fct_orders")) == rows(rebuilt)
    assert rows(read("fct_order_items")) == rows(sales)
    assert rows(read("mart_ventas_categoria")) == rows(marts.mart_ventas_categoria(sales, star.dim_product, star.dim_date))
    assert rows(read("mart_segmento_vendedor")) == rows(marts.mart_segmento_vendedor(sales, star.dim_seller, star.dim_date))
    # Payments and reviews were not part of the sets, so they stay, and the new orders have none.
    reviews = facts.fct_reviews(star.reviews, rebuilt)
    assert rows(read("fct_payments")) == rows(facts.fct_payments(star.payments, rebuilt))
    assert rows(read("fct_reviews")) == rows(reviews)
    assert rows(read("mart_satisfaccion")) == rows(marts.mart_satisfaccion(rebuilt, reviews, star.dim_date))
    assert rows(read("mart_cohortes")) == rows(marts.mart_cohortes(rebuilt, star.dim_customer, star.dim_date))


def test_customers_leave_and_enter_cohorts(spark, star, root):
    """Older orders move a first purchase back; orders that go to another customer take theirs away."""
    orders, items, month = star.orders, star.order_items, monthly.MONTH
    sizes = monthly.with_month(orders).where("purchase_month > 0").groupBy(month).count().orderBy(month).collect()
    late = monthly.with_month(orders).where(F.col(month) == sizes[40].purchase_month).drop(month)
    early = F.concat("order_id", F.lit("-early"))
    older = late.withColumns({"order_id": early, "order_purchase_timestamp": F.expr("order_purchase_timestamp - interval 700 days")})
    one = orders.agg(F.max("customer_unique_id")).first()[0]
    given = late.withColumn("customer_unique_id", F.lit(one))
    now_orders, now_items = orders, items
    for changed, new in ((older, items.withColumn("order_id", early)), (given, items)):
        ids, before = changed.select("order_id"), {table: files(root, table) for table in monthly.BY_COHORT}
        people = now_orders.join(ids, "order_id", "left_semi").unionByName(changed).select("customer_unique_id").distinct().cache()
        cohorts = lambda seen: dimensions.first_purchases(seen).join(people, "customer_unique_id").select(monthly.month_of_label("cohort_year_month"))
        touched = {r[0] for r in cohorts(now_orders).collect()}
        now_orders = now_orders.join(ids, "order_id", "left_anti").unionByName(changed)
        now_items = now_items.join(ids, "order_id", "left_anti").unionByName(new.join(ids, "order_id", "left_semi"))
        touched |= {r[0] for r in cohorts(now_orders).collect()}
        later = Later(star, dim_customer=dimensions.dim_customer(star.customers, now_orders))
        monthly.apply_changes(later, root, changed, new)
        rebuilt = facts.fct_orders(now_orders, now_items, later.dim_customer, star.dim_geography)
        expected = rows(marts.mart_cohortes(rebuilt, later.dim_customer, star.dim_date))
        assert rows(monthly.read(spark, root, "mart_cohortes").drop(month)) == expected
        for table in monthly.BY_COHORT:
            after = files(root, table)
            assert {m: f for m, f in after.items() if m not in touched} == {m: f for m, f in before[table].items() if m not in touched}
            assert touched < {*after, *before[table]}
    # Repeating the last set, as after a failure, changes no row.
    monthly.apply_changes(later, root, changed, new)
    assert rows(monthly.read(spark, root, "mart_cohortes").drop(month)) == expected


def test_rows_that_came_before_their_order(spark, star):
    """Items, payments and reviews wait in the unknown month and move when their order comes."""
    dated = monthly.with_month(star.orders)
    month = dated.where("purchase_month > 0").agg(F.max(monthly.MONTH)).first()[0]
    late = dated.where(F.col(monthly.MONTH) == month).drop(monthly.MONTH)
    root = working_folder(spark, "monthly-late")
    monthly.first_load(Later(star, orders=star.orders.join(late.select("order_id"), "order_id", "left_anti").select(*star.orders.columns)), root)
    assert not monthly.read(spark, root, "payments", [-1]).isEmpty()
    assert monthly.apply_changes(star, root, late, star.order_items) == [-1, month]
    for name in ("fct_orders", "fct_order_items", "fct_payments", "fct_reviews", "mart_satisfaccion", "mart_cohortes"):
        assert rows(monthly.read(spark, root, name).drop(monthly.MONTH)) == rows(star.table(name)), name


def test_a_repeated_change_set_changes_nothing(spark, star, root):
    changed = star.orders.where("order_purchase_timestamp >= '1998-01-01' and order_purchase_timestamp < '1998-02-01'")
    monthly.apply_changes(star, root, changed, star.order_items)
    before = rows(monthly.read(spark, root, "fct_order_items"))
    monthly.apply_changes(star, root, changed, star.order_items)
    assert rows(monthly.read(spark, root, "fct_order_items")) == before
    assert monthly.apply_changes(star, root, changed.where("false"), star.order_items) == []


def test_a_snapshot_lists_thirteen_months(spark, star, root):
    assert len(monthly.months_of_window(date(2001, 1, 1))) == 13
    assert monthly.months_of_window(date(2000, 3, 31), 31) == [200002, 200003]
    found = monthly.seller_snapshot(star, root, date(1999, 1, 1))
    assert rows(found) == rows(star.seller_snapshot(date(1999, 1, 1)))
    wanted = {str(m) for m in monthly.months_of_window(date(1999, 1, 1))}
    scans = [line for line in plan_text(monthly.seller_snapshot(star, root, date(1999, 1, 1))).splitlines() if "PartitionFilters" in line]
    assert sum("PartitionFilters: [purchase_month" in scan for scan in scans) == 2
    read = monthly.read(spark, root, "orders", monthly.months_of_window(date(1999, 1, 1))).select(F.input_file_name().alias("f")).distinct()
    assert {r.f.split(f"{monthly.MONTH}=")[1][:6] for r in read.collect()} <= wanted


def test_a_change_writes_rows_once_and_lists_its_months_only(spark, monkeypatch):
    """Rows are written by month beside the table and change places; months that are not asked for are not listed."""
    folder, renamed, rename = working_folder(spark, "once"), [], monthly.paths.rename
    rows_of = lambda *months: spark.createDataFrame([(f"o{n}", n, m) for n, m in enumerate(months)], f"order_id string, n int, {monthly.MONTH} int")
    monthly.replace_months(rows_of(199801, 199802, 199803, -1), folder, "t")
    monkeypatch.setattr(monthly.paths, "rename", lambda *of: (renamed.append(of[2]), rename(*of)))
    before = files(folder, "t")
    listed = monthly.read(spark, folder, "t", [199801, 199802])
    assert {os.path.basename(os.path.dirname(f)) for f in listed.inputFiles()} == {f"{monthly.MONTH}=199801", f"{monthly.MONTH}=199802"}
    monthly.replace_months(listed.where("n = 0").unionByName(rows_of(199805)), folder, "t", [199801, 199802])
    after = files(folder, "t")
    assert sorted(os.path.basename(to) for to in renamed) == [f"{monthly.MONTH}=199801", f"{monthly.MONTH}=199805"]
    assert sorted(after) == [-1, 199801, 199803, 199805] and all(after[m] == before[m] for m in (-1, 199803))
    assert sorted(map(tuple, monthly.read(spark, folder, "t").collect())) == [("o0", 0, 199801), ("o0", 0, 199805), ("o2", 2, 199803), ("o3", 3, -1)]
    assert os.listdir(folder) == ["t"]
    # Months that the table does not have hold no row, of the same columns.
    none = monthly.read(spark, folder, "t", [209901])
    assert none.isEmpty() and none.columns == ["order_id", "n", monthly.MONTH]


def test_customers_without_a_change_are_not_placed_anew(spark, star, root, monkeypatch):
    """Only orders of the customers of a change set meet the list of customers; the others keep their cohort."""
    placed, replace = [], monthly._replace_cohorts

    def watched(star, root, orders, members, months):
        placed.append(plan_text(orders).split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0])
        replace(star, root, orders, members, months)

    monkeypatch.setattr(monthly, "_replace_cohorts", watched)
    changed = star.orders.where("order_purchase_timestamp >= '1998-01-01' and order_purchase_timestamp < '1998-02-01'")
    monthly.apply_changes(star, root, changed, star.order_items)
    assert len(placed) == 1 and "LeftAnti, (customer_sk" in placed[0] and placed[0].count("Join Inner, (customer_sk") == 1
    stays = placed[0][: placed[0].index("Join Inner")]
    assert "LeftAnti, (customer_sk" in stays
    assert rows(monthly.read(spark, root, "mart_cohortes").drop(monthly.MONTH)) == rows(star.mart_cohortes)
    held = monthly.read(spark, root, "cohort_orders").join(monthly.read(spark, root, "cohort_members"), ["customer_sk", monthly.MONTH])
    assert held.count() == monthly.read(spark, root, "cohort_orders").count() > 0
