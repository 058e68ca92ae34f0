"""Landing, bronze and published tables: written, read back, compared with what went in."""

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.plans import silver
from lakeloom.plans.star import Star
from lakeloom.registry import query
from lakeloom.session import working_folder
from lakeloom.sources import bronze, landing, tables

FIRST, SECOND = date(2026, 8, 1), date(2026, 8, 2)


@query("S1_read_landing", "select * from raw_reviews")
def read_landing(star):
    """Text with line breaks and quotes through CSV and back; blank stays text, ``NA`` too."""
    folder = working_folder(star.spark, "landing")
    landing.write_landing(star.raw.reviews, folder, "reviews")
    return landing.read_landing(star.spark, folder, "reviews")


@query(
    "S2_landing_tables",
    """select 'customers' as table_name, count(*) as row_count from raw_customers
       union all select 'payments', count(*) from raw_payments union all select 'sellers', count(*) from raw_sellers""",
)
def landing_tables(star):
    """All extracts of a landing folder, found by their file names."""
    folder = working_folder(star.spark, "landing")
    for name in ("customers", "payments", "sellers"):
        landing.write_landing(getattr(star.raw, name), folder, name)
    found = landing.landing_tables(star.spark, folder, ["all"])
    counted = [
        landing.read_landing(star.spark, folder, name).agg(
            F.lit(name).alias("table_name"), F.count("*").alias("row_count")
        )
        for name in found
    ]
    return reduce(DataFrame.unionByName, counted)


def _two_days(star: Star) -> str:
    """Orders ingested on two days; by the second, canceled orders are gone from the source."""
    root = working_folder(star.spark, "bronze")
    bronze.write_bronze(star.raw.orders, root, "orders", FIRST)
    bronze.write_bronze(star.raw.orders.where("order_status <> 'canceled'"), root, "orders", SECOND)
    return root


@query("S3_read_bronze", "select * from raw_orders where order_status <> 'canceled'")
def read_bronze(star):
    return bronze.read_bronze(star.spark, _two_days(star), "orders", SECOND)


@query(
    "S4_resolve_ingestion_date",
    """select 'latest' as asked, date '2026-08-02' as ingestion_date, count(*) filter (where order_status <> 'canceled') as row_count
       from raw_orders union all select 'requested', date '2026-08-01', count(*) from raw_orders""",
)
def resolve_ingestion_date(star):
    root = _two_days(star)
    asked = {"latest": None, "requested": FIRST}
    found = []
    for name, requested in asked.items():
        day = bronze.resolve_ingestion_date(star.spark, root, "orders", requested)
        snapshot = bronze.read_bronze(star.spark, root, "orders", day)
        found.append(
            snapshot.agg(
                F.lit(name).alias("asked"), F.lit(day).alias("ingestion_date"), F.count("*").alias("row_count")
            )
        )
    return reduce(DataFrame.unionByName, found)


@query("S5_read_silver", "select * from s_orders")
def read_silver(star):
    """Published twice; readers get the later version."""
    root = working_folder(star.spark, "silver")
    tables.publish(star.orders.where("order_status = 'DELIVERED'"), root, "orders", ["order_id"])
    tables.publish(star.orders, root, "orders", ["order_id"])
    return tables.read_table(star.spark, root, "orders")


@query("S6_read_gold", "select * from f_payments")
def read_gold(star):
    return star.table("fct_payments")


@query(
    "K1_write_bronze",
    """select date '2026-08-01' as ingestion_date, count(*) as row_count, count(distinct order_id) as orders from raw_orders
       union all select date '2026-08-02', count(*), count(distinct order_id) from raw_orders where order_status <> 'canceled'""",
)
def write_bronze(star):
    """A day written again replaces itself and nothing else."""
    root = _two_days(star)
    bronze.write_bronze(star.raw.orders, root, "orders", FIRST)
    written = star.spark.read.parquet(f"{root}/orders")
    return written.groupBy("ingestion_date").agg(
        F.count("*").alias("row_count"), F.count_distinct("order_id").alias("orders")
    )


@query(
    "K1_bronze_to_silver",
    """select *, timestamp '2026-08-01 06:30:00' as _ingested_at, 'sellers.csv' as _source_file from s_sellers""",
)
def bronze_to_silver(star):
    """CSV to bronze with audit columns, bronze to the silver entity."""
    spark, folder = star.spark, working_folder(star.spark, "ingest")
    landing.write_landing(star.raw.sellers, f"{folder}/landing", "sellers")
    extract = landing.read_landing(spark, f"{folder}/landing", "sellers")
    audited = bronze.with_audit(extract, "sellers", datetime(2026, 8, 1, 6, 30), "sellers.csv")
    bronze.write_bronze(audited, f"{folder}/bronze", "sellers", FIRST)
    day = bronze.read_bronze(spark, f"{folder}/bronze", "sellers")
    audit = day.select("seller_id", "_ingested_at", "_source_file")
    return silver.sellers(day).join(audit, "seller_id")


@query("K2_publish_with_key_gate", "select * from s_items")
def publish_with_key_gate(star):
    """A version with duplicate keys is refused and the last good one stays in place."""
    root = working_folder(star.spark, "silver")
    key = ["order_id", "order_item_id"]
    tables.publish(star.order_items, root, "order_items", key)
    try:
        tables.publish(star.order_items.unionByName(star.order_items), root, "order_items", key)
    except tables.KeyViolation:
        return tables.read_table(star.spark, root, "order_items")
    raise AssertionError("duplicate keys were published")


@query(
    "K3_publish_layers",
    """select 'orders' as table_name, count(*) as row_count from s_orders
       union all select 'dim_customer', count(*) from d_customer union all select 'fct_orders', count(*) from f_orders""",
)
def publish_layers(star):
    """Silver and gold tables are published the same way, below their layer."""
    names = ("orders", "dim_customer", "fct_orders")
    own = Star(star.raw, star.rules, working_folder(star.spark, "warehouse"))
    written = [own.table(n).agg(F.lit(n).alias("table_name"), F.count("*").alias("row_count")) for n in names]
    return reduce(DataFrame.unionByName, written)


@query("K4_schema_enforcement", "select customer_unique_id, customer_city as city, customer_state from s_customers")
def schema_enforcement(star):
    """Other columns are refused unless asked for."""
    root = working_folder(star.spark, "silver")
    key = ["customer_unique_id"]
    tables.publish(star.customers, root, "customers", key)
    other = star.customers.select("customer_unique_id", F.col("customer_city").alias("city"), "customer_state")
    try:
        tables.publish(other, root, "customers", key)
    except tables.SchemaDrift:
        tables.publish(other, root, "customers", key, overwrite_schema=True)
        return tables.read_table(star.spark, root, "customers")
    raise AssertionError("a changed schema was published")


@query("K8_materialised_mart", "select * from m_categoria")
def materialised_mart(star):
    return star.mart_ventas_categoria
