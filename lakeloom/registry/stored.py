"""Reading as things arrive and keeping partial results: split extracts, deliveries, stored counts and medians."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators import stored
from lakeloom.plans import requirements as R
from lakeloom.plans.marts import known_days
from lakeloom.registry import query
from lakeloom.session import working_folder
from lakeloom.sources import bronze, deliveries, landing, split_csv


@query("S1_read_landing_split", "select * from raw_reviews")
def read_landing_split(star):
    """Text with line breaks and quotes in one file, read back by many tasks."""
    folder = working_folder(star.spark, "landing")
    landing.write_landing(star.raw.reviews, folder, "reviews")
    return split_csv.read_split(star.spark, f"{folder}/reviews.csv")


# Extracts that SQL texts know by a shorter name.
SHORT = {"order_items": "items", "geolocation": "geo"}


@query(
    "S2_all_extracts",
    " union all ".join(
        f"select '{name}' as table_name, count(*) as row_count from raw_{SHORT.get(name, name)}" for name in bronze.SOURCES
    ),
)
def all_extracts(star):
    """Every extract of a full landing folder, found by its file name and counted as it is read."""
    folder = working_folder(star.spark, "landing")
    for name in bronze.SOURCES:
        landing.write_landing(getattr(star.raw, name), folder, name)
    found = landing.landing_tables(star.spark, folder, ["all"])
    read = [landing.read_landing(star.spark, folder, name) for name in found]
    counted = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count")) for name, df in zip(found, read, strict=True)]
    return reduce(DataFrame.unionByName, counted)


@query(
    "K1_ingest_new_files",
    "select *, case when order_status = 'canceled' then 0 else 1 end as load, true as from_its_delivery from raw_orders",
)
def ingest_new_files(star):
    """Two deliveries, three runs: the second run takes the new files only, the third finds none."""
    spark, folder = star.spark, working_folder(star.spark, "deliveries")
    canceled = F.col("order_status") == "canceled"
    for part, name in ((canceled, "first"), (~canceled, "second"), (None, "none")):
        if part is not None:
            landing.write_landing(star.raw.orders.where(part), f"{folder}/landing/orders", name)
        deliveries.ingest_new(spark, f"{folder}/landing", f"{folder}/bronze", "orders", f"{folder}/checkpoint")
    taken = spark.read.parquet(f"{folder}/bronze/orders")
    named = F.when(F.col("load") == 0, "/first.csv/").otherwise("/second.csv/")
    return taken.select(
        *star.raw.orders.columns, "load", F.contains("_source_file", named).alias("from_its_delivery")
    )


# The hour of arrival comes from the order; nothing is ingested for orders whose key ends in 3.
@query(
    "X11_ingested_freshness",
    """with loads as (select cast(o_orderdate as date) as day, min(o_orderkey % 20) as h from orders where o_orderkey % 10 <> 3 group by 1),
            days as (select distinct cast(o_orderdate as date) as day from orders)
       select year(day) || '-Q' || quarter(day) as year_quarter, count(*) as days, count(*) filter (where h <= 7) as on_time,
       count(*) filter (where h <= 7) / count(*) as rate, count(*) filter (where h <= 7) / count(*) >= 0.99 as met
       from days left join loads using (day) group by 1""",
)
def ingested_freshness(star):
    """Freshness from the load moments that rows carry."""
    orders = star.raw.given("orders").select(F.to_date("o_orderdate").alias("day"), "o_orderkey")
    arrival = F.date_add("day", 1).cast("timestamp") + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 20).cast("int"))
    audited = orders.select("day", F.when(F.col("o_orderkey") % 10 != 3, arrival).alias("_ingested_at"))
    return R.freshness(audited.select("day").distinct(), deliveries.load_moments(audited))


def _stored(df, folder):
    """Written once, as a day's partials are, and read from there."""
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


@query(
    "A9_stored_distinct",
    """select 'month' as period, year_month as name, count(distinct customer_sk) as customers
       from f_orders join d_date on date_sk = purchase_date_sk where date_sk <> -1 group by 2
       union all
       select 'quarter', cast("year" as varchar) || '-Q' || cast("quarter" as varchar), count(distinct customer_sk)
       from f_orders join d_date on date_sk = purchase_date_sk where date_sk <> -1 group by 2""",
)
def stored_distinct(star):
    """Customers by month and by quarter, both merged from the same daily bitmaps."""
    root = working_folder(star.spark, "bitmaps")
    members = _stored(stored.new_members(star.fct_orders, "customer_sk"), f"{root}/members")
    daily = stored.member_bitmaps(star.fct_orders, ["purchase_date_sk"], "customer_sk", members)
    days = known_days(star.dim_date, "year_month", "year", "quarter").withColumnRenamed("date_sk", "purchase_date_sk")
    dated = _stored(daily, f"{root}/daily").join(days, "purchase_date_sk")
    quarter = F.concat(F.col("year").cast("string"), F.lit("-Q"), F.col("quarter").cast("string"))
    by_month = stored.distinct_members(dated.withColumn("name", F.col("year_month")), ["name"], "customers")
    by_quarter = stored.distinct_members(dated.withColumn("name", quarter), ["name"], "customers")
    return by_month.select(F.lit("month").alias("period"), "*").unionByName(by_quarter.select(F.lit("quarter").alias("period"), "*"))


@query(
    "A2_stored_median",
    """select product_category_name, count(price) as items, true as median_holds from f_items join d_product using (product_sk) group by 1""",
)
def stored_median(star):
    """Median price by category, merged from sketches by product and held against the place it has among all prices."""
    root = working_folder(star.spark, "sketches")
    by_product = _stored(stored.value_sketches(star.fct_order_items, ["product_sk"], F.col("price")), f"{root}/products")
    category = star.dim_product.select("product_sk", "product_category_name")
    medians = stored.merged_median(by_product.join(category, "product_sk"), ["product_category_name"], "median")
    same = F.col("of.product_category_name").eqNullSafe(F.col("m.product_category_name"))
    placed = star.fct_order_items.join(category, "product_sk").alias("of").join(medians.alias("m"), same)
    price, items = F.col("price").cast("double"), F.count("price")
    low = F.count_if(price < F.col("median")) <= items * (0.5 + stored.RANK_ERROR)
    high = F.count_if(price <= F.col("median")) >= items * (0.5 - stored.RANK_ERROR)
    return placed.groupBy("of.product_category_name").agg(items.alias("items"), (low & high).alias("median_holds"))
