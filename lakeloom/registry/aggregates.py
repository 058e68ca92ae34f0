"""Aggregations and per-key choices."""

from datetime import date

from pyspark.sql import functions as F

from lakeloom.functions import attributes as A
from lakeloom.operators.grouping import latest_per_key, median_per_key, mode_per_key
from lakeloom.plans import dimensions, facts, marts, silver
from lakeloom.registry import query
from lakeloom.sources.tables import key_profile


@query(
    "A1_count_and_distinct_key",
    """select count(*) as row_count, count(distinct (order_id, order_item_id)) as distinct_keys from s_items""",
)
def count_and_distinct_key(star):
    return key_profile(star.order_items, ["order_id", "order_item_id"])


@query("A2_median", "select zip_code_prefix, latitude, longitude from s_geolocation")
def median(star):
    points = silver.geolocation_points(star.raw.geolocation)
    return median_per_key(points, ["zip_code_prefix"], latitude=F.col("lat"), longitude=F.col("lng"))


@query(
    "A3_frequency",
    "select zip_code_prefix, city, state, count(*) as occurrences from geo_points group by all",
)
def frequency(star):
    points = silver.geolocation_points(star.raw.geolocation)
    return points.groupBy("zip_code_prefix", "city", "state").agg(F.count("*").alias("occurrences"))


@query("A4_first_purchase", "select customer_unique_id, first_purchase_date from first_purchases")
def first_purchase(star):
    return dimensions.first_purchases(star.orders).select("customer_unique_id", "first_purchase_date")


@query(
    "A5_order_rollup",
    """select order_id, count(*) as order_item_count, sum(price + freight_value) as order_value
       from s_items group by 1""",
)
def order_rollup(star):
    return facts.order_totals(star.order_items)


@query("A6_trailing_gmv", "select seller_id, gmv_window from seller_snapshots where as_of = date '2001-01-01'")
def trailing_gmv(star):
    return star.seller_snapshot(date(2001, 1, 1)).select("seller_id", "gmv_window")


@query(
    "A7_category_sums",
    """select product_category, sum(gmv) as gmv, sum(ingreso_flete) as freight, sum(margen_contribucion) as margin,
       cast(sum(items_vendidos) as bigint) as items from m_categoria group by 1""",
)
def category_sums(star):
    def total(name):
        return F.sum(name).cast("decimal(38,2)")

    return star.mart_ventas_categoria.groupBy("product_category").agg(
        total("gmv").alias("gmv"),
        total("ingreso_flete").alias("freight"),
        total("margen_contribucion").alias("margin"),
        F.sum("items_vendidos").alias("items"),
    )


@query(
    "A8_segment_sums",
    """select seller_segment, sum(price) as gmv, count(order_item_id) as items, count(distinct order_id) as orders
       from f_items join d_seller using (seller_sk) group by 1""",
)
def segment_sums(star):
    return (
        star.fct_order_items.join(star.dim_seller.select("seller_sk", "seller_segment"), "seller_sk")
        .groupBy("seller_segment")
        .agg(
            F.sum("price").cast("decimal(38,2)").alias("gmv"),
            F.count("order_item_id").alias("items"),
            F.count_distinct("order_id").alias("orders"),
        )
    )


@query(
    "A9_filtered_distinct",
    """select cohort_year_month, count(distinct customer_sk) filter (where relative_month between 1 and 6) as back_in_6
       from activity group by 1""",
)
def filtered_distinct(star):
    activity = marts.order_activity(star.fct_orders, star.dim_customer, star.dim_date)
    return marts.cohorts(activity).select("cohort_year_month", F.col("recompra_6m").alias("back_in_6"))


@query(
    "A10_satisfaction",
    """select review_score, cast(sum(review_count) as bigint) as reviews,
       cast(sum(response_time_hours) as double) / count(response_time_hours) as mean_hours from f_reviews group by 1""",
)
def satisfaction(star):
    return star.fct_reviews.groupBy("review_score").agg(
        F.sum("review_count").alias("reviews"), A.exact_avg(F.col("response_time_hours")).alias("mean_hours")
    )


@query(
    "A11_exploration",
    """select state, count(*) as observations, count(distinct zip_code_prefix) as zips,
       cast(sum(cast(lat as decimal(12,2))) as double) / count(lat) as mean_lat from geo_points group by 1""",
)
def exploration(star):
    points = silver.geolocation_points(star.raw.geolocation)
    return points.groupBy("state").agg(
        F.count("*").alias("observations"),
        F.count_distinct("zip_code_prefix").alias("zips"),
        A.exact_avg(F.col("lat").cast("decimal(12,2)")).alias("mean_lat"),
    )


@query(
    "A12_group_by_ordinal",
    "select payment_type, payment_installments, count(*) as payments from f_payments group by 1, 2",
)
def group_by_ordinal(star):
    star.fct_payments.createOrReplaceTempView("gold_fct_payments")
    return star.spark.sql(
        "select payment_type, payment_installments, count(*) as payments from gold_fct_payments group by 1, 2"
    )


@query("W1_latest_per_key", "select customer_unique_id, customer_city, customer_state from s_customers")
def latest(star):
    people = star.raw.customers.select("customer_id", "customer_unique_id", "customer_city", "customer_state")
    bought = star.orders.select("customer_id", "order_purchase_timestamp")
    newest = latest_per_key(
        people.join(bought, "customer_id", "left"),
        ["customer_unique_id"],
        newest=["order_purchase_timestamp", "customer_id"],
        keep=["customer_city", "customer_state"],
    )
    return newest.select(
        "customer_unique_id",
        silver.clean_text("customer_city").alias("customer_city"),
        silver.clean_code("customer_state").alias("customer_state"),
    )


@query("W2_mode_per_key", "select * from geo_mode")
def mode(star):
    return mode_per_key(silver.geolocation_points(star.raw.geolocation), ["zip_code_prefix"], ["city", "state"])


@query(
    "W3_city_mode",
    """select zip_code_prefix, city from (select zip_code_prefix, city, count(*) as n from geo_points group by all)
       qualify row_number() over (partition by zip_code_prefix order by n desc, city nulls first) = 1""",
)
def city_mode(star):
    return mode_per_key(silver.geolocation_points(star.raw.geolocation), ["zip_code_prefix"], ["city"])
