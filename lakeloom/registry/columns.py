"""Scalar operators, each over a whole extract or published table."""

from datetime import date, datetime

from pyspark.sql import functions as F

from lakeloom.functions import attributes as A
from lakeloom.functions import cleaning as C
from lakeloom.functions import keys
from lakeloom.operators.dimension import with_unknown_member
from lakeloom.plans import dimensions, silver
from lakeloom.registry import query
from lakeloom.registry import oracle as sql
from lakeloom.sources import bronze

AUDIT_MOMENT = datetime(2026, 8, 1, 6, 30)


@query(
    "P1_clean_text",
    f"select customer_id, {sql.clean_text('customer_city')} as city from raw_customers",
)
def clean_text(star):
    return star.raw.customers.select("customer_id", C.clean_text("customer_city").alias("city"))


@query(
    "P2_clean_code",
    f"""select order_id, {sql.clean_code('order_status')} as status,
        {sql.clean_code('customer_state')} as state from raw_orders join raw_customers using (customer_id)""",
)
def clean_code(star):
    states = star.raw.customers.select("customer_id", C.clean_code("customer_state").alias("state"))
    return (
        star.raw.orders.select("customer_id", "order_id", C.clean_code("order_status").alias("status"))
        .join(states, "customer_id")
        .drop("customer_id")
    )


@query(
    "P3_to_timestamp",
    f"""select order_id, {sql.as_ts('order_purchase_timestamp')} as bought,
        {sql.as_ts('order_approved_at')} as approved from raw_orders""",
)
def to_timestamp(star):
    return star.raw.orders.select(
        "order_id",
        C.to_timestamp("order_purchase_timestamp").alias("bought"),
        C.to_timestamp("order_approved_at").alias("approved"),
    )


@query(
    "P4_to_money",
    f"""select order_id, order_item_id, {sql.as_money('price')} as price, {sql.as_money('freight_value')} as freight
        from raw_items""",
)
def to_money(star):
    return star.raw.order_items.select(
        "order_id", "order_item_id", C.to_money("price").alias("price"), C.to_money("freight_value").alias("freight")
    )


@query(
    "P5_typed_casts",
    f"""select product_id, {sql.as_int('product_weight_g')} as grams, {sql.as_int('product_photos_qty')} as photos
        from raw_products""",
)
def typed_casts(star):
    return star.raw.products.select(
        "product_id", C.to_int("product_weight_g").alias("grams"), C.to_int("product_photos_qty").alias("photos")
    )


@query(
    "P5_double_cast",
    """select geolocation_zip_code_prefix as zip, try_cast(geolocation_lat as double) as lat,
       try_cast(geolocation_lng as double) as lng from raw_geo""",
)
def double_cast(star):
    return star.raw.geolocation.select(
        F.col("geolocation_zip_code_prefix").alias("zip"),
        C.to_double("geolocation_lat").alias("lat"),
        C.to_double("geolocation_lng").alias("lng"),
    )


@query(
    "P6_blank_to_null",
    f"""select review_id, order_id, {sql.blank_null('review_comment_title')} as title,
        {sql.blank_null('review_comment_message')} as message from raw_reviews""",
)
def blank_to_null(star):
    return star.raw.reviews.select(
        "review_id",
        "order_id",
        C.blank_to_null("review_comment_title").alias("title"),
        C.blank_to_null("review_comment_message").alias("message"),
    )


@query(
    "P7_rename",
    """select product_id, product_name_lenght as product_name_length,
       product_description_lenght as product_description_length from raw_products""",
)
def rename(star):
    return star.raw.products.select(
        "product_id",
        F.col("product_name_lenght").alias("product_name_length"),
        F.col("product_description_lenght").alias("product_description_length"),
    )


@query(
    "P8_audit_columns",
    f"""select *, timestamp '{AUDIT_MOMENT}' as _ingested_at, 'sellers.csv' as _source_file,
        '{keys.batch_id("sellers", AUDIT_MOMENT.date())}' as _batch_id from raw_sellers""",
)
def audit_columns(star):
    return bronze.with_audit(star.raw.sellers, "sellers", AUDIT_MOMENT, "sellers.csv")


@query(
    "P9_batch_id",
    f"""select order_id, case when o_month = 1 then '{keys.batch_id("orders", date(2026, 1, 1))}'
        else '{keys.batch_id("orders", date(2026, 2, 1))}' end as batch
        from (select order_id, case when month({sql.as_ts("order_purchase_timestamp")}) <= 6 then 1 else 2 end as o_month
              from raw_orders)""",
)
def batch_id(star):
    first, second = (keys.batch_id("orders", date(2026, m, 1)) for m in (1, 2))
    early = F.month(C.to_timestamp("order_purchase_timestamp")) <= 6
    return star.raw.orders.select("order_id", F.when(early, first).otherwise(second).alias("batch"))


@query("P10_surrogate_key", "select customer_id, sha256(customer_unique_id) as customer_sk from s_orders")
def surrogate_key(star):
    return star.orders.select("customer_id", keys.surrogate_key("customer_unique_id").alias("customer_sk"))


@query(
    "P11_version_key",
    """select as_of, seller_id, case when seller_id = '-1' then '-1' else sha256(seller_id || '|' || as_of) end as version_sk
       from seller_snapshots""",
)
def version_key(star):
    return star.seller_snapshots.select(
        "as_of", "seller_id", keys.version_key("seller_id", "as_of").alias("version_sk")
    )


@query(
    "P12_date_key",
    f"""select order_id, {sql.date_sk('order_purchase_timestamp')} as bought_sk,
        {sql.date_sk('order_delivered_customer_date')} as delivered_sk from s_orders""",
)
def date_key(star):
    return star.orders.select(
        "order_id",
        keys.date_key("order_purchase_timestamp").alias("bought_sk"),
        keys.date_key("order_delivered_customer_date").alias("delivered_sk"),
    )


@query(
    "P13_resolve_key",
    """select order_id, order_item_id, coalesce(product_sk, '-1') as product_sk
       from s_items left join d_product using (product_id)""",
)
def resolve_key(star):
    products = star.dim_product.select("product_id", "product_sk")
    return star.order_items.join(products, "product_id", "left").select(
        "order_id", "order_item_id", keys.resolve_key("product_sk").alias("product_sk")
    )


@query(
    "P14_unknown_member",
    """select seller_id, seller_zip_code_prefix, seller_city, seller_state from s_sellers
       union all select '-1', 'Unknown', 'Unknown', 'Unknown'""",
)
def unknown_member(star):
    return with_unknown_member(star.sellers, "seller_id")


@query("P15_region", "select zip_code_prefix, state, region from d_geography where zip_code_prefix <> 'Unknown'")
def region(star):
    return star.geolocation.select("zip_code_prefix", "state", A.region_of(F.col("state")).alias("region"))


@query("P16_weight_bucket", "select product_id, weight_bucket from d_product where product_id <> 'Unknown'")
def weight_bucket(star):
    return star.products.select("product_id", A.weight_bucket(F.col("product_weight_g")).alias("weight_bucket"))


@query("P17_volume", "select product_id, product_volume_cm3 from d_product where product_id <> 'Unknown'")
def volume(star):
    sides = [F.col(f"product_{side}_cm") for side in ("length", "height", "width")]
    return star.products.select("product_id", A.volume_cm3(*sides).alias("product_volume_cm3"))


@query(
    "P18_segment",
    """select seller_id, as_of, case when gmv_window > 5200000 then 'Gold' when gmv_window >= 4500000 then 'Silver'
       else 'Bronze' end as segment from seller_snapshots""",
)
def segment(star):
    return star.seller_snapshots.select(
        "seller_id", "as_of", A.segment_of(F.col("gmv_window"), **star.rules.segments).alias("segment")
    )


@query(
    "P19_calendar_attributes",
    """select order_id, cast(year(d) as int) as year, cast(quarter(d) as int) as quarter, cast(month(d) as int) as month,
       strftime(d, '%B') as month_name, cast(weekofyear(d) as int) as week_of_year, cast(day(d) as int) as day_of_month,
       cast(dayofweek(d) + 1 as int) as day_of_week, strftime(d, '%A') as day_name,
       dayofweek(d) in (0, 6) as is_weekend, strftime(d, '%Y-%m') as year_month,
       year(d) || '-Q' || quarter(d) as year_quarter
       from (select order_id, cast(order_estimated_delivery_date as date) as d from s_orders)""",
)
def calendar_attributes(star):
    days = star.orders.select("order_id", F.to_date("order_estimated_delivery_date").alias("d"))
    return days.select("order_id", *A.calendar_attributes("d"))


@query("P20_delivery_days", "select order_id, days_to_delivery, days_late from f_orders")
def delivery_days(star):
    return star.plan("fct_orders").select("order_id", "days_to_delivery", "days_late")


@query("P21_delivery_flags", "select order_id, is_delivered, is_late from f_orders")
def delivery_flags(star):
    return star.orders.select(
        "order_id",
        A.is_delivered(F.col("order_status")).alias("is_delivered"),
        A.is_late(F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")).alias("is_late"),
    )


@query("P22_review_flags", "select review_id, order_id, is_negative, is_positive from f_reviews")
def review_flags(star):
    score = F.col("review_score")
    return star.reviews.select(
        "review_id", "order_id", A.is_negative(score).alias("is_negative"), A.is_positive(score).alias("is_positive")
    )


@query("P23_response_hours", "select review_id, order_id, response_time_hours from f_reviews")
def response_hours(star):
    hours = A.hours_between(F.col("review_creation_date"), F.col("review_answer_timestamp"))
    return star.reviews.select("review_id", "order_id", hours.alias("response_time_hours"))


@query("P24_gross_revenue", "select order_id, order_item_id, gross_revenue, item_count from f_items")
def gross_revenue(star):
    return star.order_items.select(
        "order_id",
        "order_item_id",
        (F.col("price") + F.col("freight_value")).alias("gross_revenue"),
        F.lit(1).alias("item_count"),
    )


@query("P25_cohort_month", "select * from first_purchases")
def cohort_month(star):
    return dimensions.first_purchases(star.orders)


@query(
    "P26_relative_month",
    """select order_id, cast((year(order_purchase_timestamp) - year(first_purchase_date)) * 12
       + month(order_purchase_timestamp) - month(first_purchase_date) as int) as relative_month
       from s_orders join first_purchases using (customer_unique_id)""",
)
def relative_month(star):
    first = dimensions.first_purchases(star.orders)
    months = A.months_since(F.col("first_purchase_date"), F.col("order_purchase_timestamp"))
    return star.orders.join(first, "customer_unique_id").select("order_id", months.alias("relative_month"))


@query(
    "P27_delay_bucket",
    """select order_id, case when is_late = 0 then 'a tiempo' when days_late <= 3 then '1-3 dias'
       when days_late <= 7 then '4-7 dias' else '>7 dias' end as tramo_retraso from f_orders""",
)
def delay_bucket(star):
    return star.fct_orders.select(
        "order_id", A.delay_bucket(F.col("is_late"), F.col("days_late")).alias("tramo_retraso")
    )


@query(
    "P28_category_label",
    """select product_id, coalesce(product_category_name_english, 'Sin categoria') as product_category from s_products""",
)
def category_label(star):
    label = A.category_label(F.col("product_category_name_english"))
    return star.products.select("product_id", label.alias("product_category"))


@query(
    "P29_role_playing_dates",
    """select order_id, b.year_month as bought_month, d.year_month as delivered_month, e.year_month as estimated_month
       from f_orders join d_date b on b.date_sk = purchase_date_sk join d_date d on d.date_sk = delivered_date_sk
       join d_date e on e.date_sk = estimated_date_sk""",
)
def role_playing_dates(star):
    def role(name, key):
        return star.dim_date.select(F.col("date_sk").alias(key), F.col("year_month").alias(name))

    return (
        star.fct_orders.join(role("bought_month", "purchase_date_sk"), "purchase_date_sk")
        .join(role("delivered_month", "delivered_date_sk"), "delivered_date_sk")
        .join(role("estimated_month", "estimated_date_sk"), "estimated_date_sk")
        .select("order_id", "bought_month", "delivered_month", "estimated_month")
    )


@query("P7_category_catalogue", "select * from s_categories")
def category_catalogue(star):
    return silver.category_catalogue(star.raw.categories)
