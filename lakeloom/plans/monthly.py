"""Silver, facts and marts by month of purchase, and change sets that touch their months only.

Each table is a folder with one partition a month. A change set holds whole orders: the order and all of its items,
payments and reviews as they are now; equal orders in later sets replace them. It names the months it touches, as the
moment of purchase of an order never changes. Only those months are read, and of each table only those are written again, by
Spark's dynamic partition overwrite. Facts are per order and three marts per month, so what stands in other months cannot
have changed. Rows that came before their order, or before its moment was known, stand in the unknown month, which a
change set touches if it brings their order.

The mart of cohorts is by the month of a customer's *first* purchase. Orders are kept a second time by that month, narrow
(``cohort_orders``), with the customers of each cohort (``cohort_members``). A change set reads and writes the cohorts
that its customers have left or entered; the members, three columns, are read in full, as the dimension of customers is.

The rows of a change set are written whole beside the table before they take the places of the partitions they were read from, so a job
that is repeated after a failure finds either the old or the new rows of a month, and repeating a change set changes nothing.
What tells where rows were before (members, the order fact) is replaced after what is derived from it.
Readers of several tables that must agree read them between runs. Tables that do not depend on each other are written at the same time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions import constants as K
from lakeloom.functions.keys import date_key, packed, unpacked
from lakeloom.plans import dimensions, facts, marts
from lakeloom.session import at_once, short_shuffles, working_folder
from lakeloom.sources import paths
from lakeloom.sources.tables import CODEC

MONTH = "purchase_month"
DETAILS = ("order_items", "payments", "reviews")
BY_PURCHASE = (
    "orders",
    *DETAILS,
    "fct_orders",
    "fct_order_items",
    "fct_payments",
    "fct_reviews",
    "mart_ventas_categoria",
    "mart_segmento_vendedor",
    "mart_satisfaccion",
)
BY_COHORT = ("cohort_orders", "cohort_members", "mart_cohortes")
TABLES = BY_PURCHASE + BY_COHORT

# Columns of so many values that a file would begin a dictionary of them only to drop it.
NO_DICTIONARY = ("order_id", "customer_id", "customer_unique_id", "customer_sk", "product_sk", "review_id")

_OF_COHORT = ("customer_sk", "order_id", "purchase_date_sk", "order_value")


def month_of(key: Column) -> Column:
    """The month of a date key; that of the unknown date is the unknown date."""
    return F.when(key == K.UNKNOWN_DATE_KEY, K.UNKNOWN_DATE_KEY).otherwise(F.floor(key / 100)).cast("int")


def month_of_label(label: str) -> Column:
    """The month of a label as ``2018-01``; without one, or with that of the unknown member, the unknown month."""
    return F.coalesce(F.regexp_replace(label, "-", "").try_cast("int"), F.lit(K.UNKNOWN_DATE_KEY))


def with_month(orders: DataFrame) -> DataFrame:
    return orders.withColumn(MONTH, month_of(date_key("order_purchase_timestamp")))


def read(spark: SparkSession, root: str, table: str, months: Iterable[int] | None = None) -> DataFrame:
    """A table, or some months of it, of which no others are listed."""
    folder = f"{root}/{table}"
    if months is None:
        return spark.read.parquet(folder)
    months = [*months]
    held = {month: f"{folder}/{MONTH}={month}" for month in _held_months(spark, folder).intersection(months)}
    # Without any of them the table still tells the columns.
    rows = spark.read.option("basePath", folder).parquet(*held.values()) if held else spark.read.parquet(folder)
    return rows.where(F.col(MONTH).isin(*months))


def _held_months(spark: SparkSession, folder: str) -> set[int]:
    return {int(name.split("=", 1)[1]) for name in paths.names(spark, f"{folder}/{MONTH}=*")}


def _staged(df: DataFrame, folder: str) -> DataFrame:
    """The rows, written once and read again."""
    with short_shuffles(df.sparkSession):
        df.write.option("compression", CODEC).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _dealt(rows: DataFrame) -> DataFrame:
    """The rows of a month in few files, however many tasks wrote them; a very large month is many. Their keys move packed.

    Rows of one order come to one file, of the list of cohorts those of one customer, mostly one behind the other, so what they
    share is stored about once. They are put in order of their months, which a write needs, while they are narrow.
    """
    keys = [name for name, kind in rows.dtypes if kind == "string" and name.endswith("_sk")]
    narrow = packed(rows, *keys)
    near = "customer_sk_bytes" if {*rows.columns} == {*_OF_COHORT, MONTH} else "order_id"
    spread = F.xxhash64(*narrow.columns)
    if near in narrow.columns:
        spread = F.when(F.col(near).isNull(), spread).otherwise(F.xxhash64(near))
    dealt = narrow.repartition(MONTH, F.pmod(spread, F.lit(8))).sortWithinPartitions(MONTH)
    return unpacked(dealt, *keys).select(*rows.columns)


def replace_months(
    df: DataFrame, root: str, table: str, months: Iterable[int] | None = None, ended: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Replace the months that ``df`` has rows of; of ``months`` those without rows are emptied.

    ``ended`` makes the rows of the table of narrower ones, once they are dealt out. Without ``months`` all of them are loaded
    from elsewhere. Otherwise ``df`` may read what it replaces, so its rows are written beside the table first, by month, and
    the folders of months change places when all rows are there. Rows are written once either way.
    """
    spark, place = df.sparkSession, f"{root}/{table}"
    beside = place if months is None else f"{root}/_{table}-{uuid.uuid4().hex}"
    dealt = ended(_dealt(df)) if ended else _dealt(df)
    with short_shuffles(spark):
        into = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC)
        into = into.options(**{f"parquet.enable.dictionary#{name}": "false" for name in NO_DICTIONARY if name in dealt.columns})
        into.partitionBy(MONTH).parquet(beside)
    if months is not None:
        written = _held_months(spark, beside)
        for month in sorted(written.union(months)):
            paths.remove(spark, f"{place}/{MONTH}={month}")
            if month in written:
                paths.rename(spark, f"{beside}/{MONTH}={month}", f"{place}/{MONTH}={month}")
        paths.remove(spark, beside)


def _months(*rows: DataFrame) -> set[int]:
    """The months of the rows, as many as the calendar has at most."""
    return {row[0] for df in rows for row in df.select(MONTH).distinct().collect()}


def _derive_orders(star, root: str, months: Iterable[int] | None) -> None:
    """The order fact of the silver tables of some months, or of all."""
    orders, items = (read(star.spark, root, table, months).drop(MONTH) for table in ("orders", "order_items"))
    rows = facts.fct_orders(orders, items, star.dim_customer, star.dim_geography)
    replace_months(rows.withColumn(MONTH, month_of(F.col("purchase_date_sk"))), root, "fct_orders", months)


def _derive(star, root: str, months: Iterable[int] | None) -> None:
    """The finer facts and the marts of the silver tables and the order fact of some months, or of all."""
    spark = star.spark

    def own(table: str) -> DataFrame:
        return read(spark, root, table, months).drop(MONTH)

    def replace(table: str, rows: DataFrame, month: Column) -> None:
        replace_months(rows.withColumn(MONTH, month), root, table, months)

    orders = own("fct_orders")

    def replace_items() -> None:
        # No digest of a product or a seller moves with an item: it follows from id and day once rows are where they stay.
        sales = facts.items_with_keys(own("order_items"), orders, star.dim_product, star.dim_seller)
        columns = ("_product", "product_id", "_seller", "seller_id", "_since", *facts.CONTRACTS["fct_order_items"])
        sales = sales.select(*[c for c in sales.columns if c in columns or c.endswith(("_bytes", "_text"))])
        month = month_of(F.coalesce("date_sk", F.lit(K.UNKNOWN_DATE_KEY)))
        replace_months(sales.withColumn(MONTH, month), root, "fct_order_items", months, lambda rows: facts.items_contracted(rows, MONTH))

    def replace_payments() -> None:
        replace("fct_payments", facts.fct_payments(own("payments"), orders), month_of(F.col("date_sk")))

    def replace_reviews() -> None:
        # A review is dated by its own creation but stands in the month of its order.
        reviews = facts.fct_reviews(own("reviews"), orders, {MONTH: month_of(F.col("date_sk"))})
        replace("fct_reviews", reviews, F.coalesce(MONTH, F.lit(K.UNKNOWN_DATE_KEY)))

    def sales() -> DataFrame:
        return own("fct_order_items")

    def items_and_theirs() -> None:
        replace_items()
        by_category = lambda: replace("mart_ventas_categoria", marts.mart_ventas_categoria(sales(), star.dim_product, star.dim_date), label)
        by_segment = lambda: replace("mart_segmento_vendedor", marts.mart_segmento_vendedor(sales(), star.dim_seller, star.dim_date), label)
        at_once(spark, by_category, by_segment)

    def reviews_and_theirs() -> None:
        replace_reviews()
        replace("mart_satisfaccion", marts.mart_satisfaccion(orders, own("fct_reviews"), star.dim_date), label)

    label = month_of_label("year_month")
    at_once(spark, items_and_theirs, replace_payments, reviews_and_theirs)


def _members(dim_customer: DataFrame) -> DataFrame:
    """Customers with the month of their first purchase."""
    known = dim_customer.where(F.col("customer_sk") != K.UNKNOWN_KEY)
    return known.select("customer_sk", "cohort_year_month", "first_purchase_date", month_of_label("cohort_year_month").alias(MONTH))


def _replace_cohorts(star, root: str, placed: DataFrame, members: DataFrame, months: Iterable[int] | None) -> None:
    """The orders, the mart and, last, the members of some cohorts, or of all; ``placed`` are orders with their cohort."""
    replace_months(placed.select(*_OF_COHORT, MONTH), root, "cohort_orders", months)
    held = read(star.spark, root, "cohort_orders", months).drop(MONTH)
    mart = marts.cohorts(marts.order_activity(held, members, star.dim_date))
    replace_months(mart.withColumn(MONTH, month_of_label("cohort_year_month")), root, "mart_cohortes", months)
    replace_months(members, root, "cohort_members", months)


def first_load(star, root: str) -> None:
    """All months of the silver tables of a warehouse, and what is derived from them."""
    spark = star.spark
    orders = with_month(star.orders)

    def load(name: str) -> None:
        rows = star.table(name).join(orders.select("order_id", MONTH), "order_id", "left")
        replace_months(rows.fillna({MONTH: K.UNKNOWN_DATE_KEY}), root, name)

    def load_cohorts() -> None:
        members = _members(star.dim_customer)
        placed = read(spark, root, "fct_orders").drop(MONTH).join(members.select("customer_sk", MONTH), "customer_sk")
        _replace_cohorts(star, root, placed, members, None)

    dimensions_of_facts = ("dim_customer", "dim_geography", "dim_product", "dim_seller", "dim_date")
    at_once(
        spark,
        lambda: replace_months(orders, root, "orders"),
        *[lambda name=name: load(name) for name in DETAILS],
        *[lambda name=name: getattr(star, name) for name in dimensions_of_facts],
    )
    _derive_orders(star, root, None)
    at_once(spark, lambda: _derive(star, root, None), load_cohorts)


def _change_cohorts(star, root: str, folder: str, changed: DataFrame, items: DataFrame, months: list[int]) -> None:
    """Bring the cohorts up to changed orders, whose old rows are still in the order fact.

    Customers without a changed order stay in their cohorts, so only the orders of the others are placed anew.
    """
    spark, ids = star.spark, changed.select("order_id")
    now = facts.fct_orders(changed.drop(MONTH), items.drop(MONTH), star.dim_customer, star.dim_geography)
    now = _staged(now.select(*_OF_COHORT), f"{folder}/facts")
    before = read(spark, root, "fct_orders", months).join(ids, "order_id", "left_semi")
    touched = now.select("customer_sk").unionByName(before.select("customer_sk")).distinct()
    touched = _staged(touched.where(F.col("customer_sk") != K.UNKNOWN_KEY), f"{folder}/customers")
    left = read(spark, root, "cohort_members").join(touched, "customer_sk", "left_semi")
    entered = _staged(_members(star.dim_customer).join(touched, "customer_sk", "left_semi"), f"{folder}/members")
    cohorts = sorted(_months(left, entered))
    if not cohorts:
        return
    stayed = read(spark, root, "cohort_members", cohorts).join(touched, "customer_sk", "left_anti")
    held = read(spark, root, "cohort_orders", cohorts).select(*_OF_COHORT, MONTH).join(ids, "order_id", "left_anti")
    moved = held.drop(MONTH).join(touched, "customer_sk", "left_semi").unionByName(now).join(entered.select("customer_sk", MONTH), "customer_sk")
    placed = held.join(touched, "customer_sk", "left_anti").unionByName(moved)
    _replace_cohorts(star, root, placed, stayed.unionByName(entered), cohorts)


def apply_changes(
    star, root: str, orders: DataFrame, items: DataFrame, payments: DataFrame | None = None, reviews: DataFrame | None = None
) -> list[int]:
    """Bring all tables up to a change set of whole orders; returns the months of purchase it touches.

    Of ``items``, ``payments`` and ``reviews`` those of other orders are not looked at; without ``payments`` or ``reviews``
    those of the orders stay as they are. The dimensions of the warehouse know the change set already.
    """
    spark = star.spark
    folder = working_folder(spark, "change-set")
    changed = _staged(with_month(orders), f"{folder}/orders")
    months = sorted(_months(changed))
    if not months:
        return []
    placed, ids = changed.select("order_id", MONTH), changed.select("order_id")
    # Rows that came before their order, or before its moment was known.
    unknown = [read(spark, root, table, [K.UNKNOWN_DATE_KEY]).join(ids, "order_id", "left_semi") for table in ("orders", *DETAILS)]
    if K.UNKNOWN_DATE_KEY not in months and not all(at_once(spark, *[rows.isEmpty for rows in unknown])):
        months = [K.UNKNOWN_DATE_KEY, *months]

    def stage(table: str, given: DataFrame | None) -> DataFrame:
        rows = read(spark, root, table, months).drop(MONTH) if given is None else given
        return _staged(rows.join(placed, "order_id"), f"{folder}/{table}")

    def replace(table: str, now: DataFrame) -> None:
        before = read(spark, root, table, months)
        kept = before.join(ids, "order_id", "left_anti")
        replace_months(kept.unionByName(now.select(*before.columns)), root, table, months)

    given = dict(zip(DETAILS, (items, payments, reviews), strict=True))
    staged = at_once(spark, *[lambda table=table: stage(table, given[table]) for table in DETAILS])
    new = {"orders": changed, **dict(zip(DETAILS, staged, strict=True))}
    at_once(
        spark,
        lambda: _change_cohorts(star, root, folder, changed, new["order_items"], months),
        *[lambda table=table: replace(table, new[table]) for table in new],
    )
    _derive_orders(star, root, months)
    _derive(star, root, months)
    paths.remove(spark, folder)
    return months


def months_of_window(as_of: date, window_days: int = K.SEGMENT_WINDOW_DAYS) -> list[int]:
    """The months that a trailing window touches: 13 for a year."""
    first, months = as_of - timedelta(days=window_days), []
    while (first.year, first.month) <= (as_of.year, as_of.month):
        months.append(first.year * 100 + first.month)
        first = (first.replace(day=1) + timedelta(days=31)).replace(day=1)
    return months


def seller_snapshot(star, root: str, as_of: date) -> DataFrame:
    """``Star.seller_snapshot``, from the months of its window alone."""
    orders, items = (read(star.spark, root, table, months_of_window(as_of)).drop(MONTH) for table in ("orders", "order_items"))
    return dimensions.seller_snapshot(star.sellers, items, orders, as_of, **star.rules.segments)
