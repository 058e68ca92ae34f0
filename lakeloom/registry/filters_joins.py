"""Filters, joins, ordering and set operations."""

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeloom.functions import attributes as A
from lakeloom.functions.constants import UNKNOWN_DATE_KEY, UNKNOWN_KEY
from lakeloom.functions.keys import resolve_key
from lakeloom.operators import history, quality
from lakeloom.operators.dimension import NO_BEGINNING, join_on_digest, point_in_time, point_in_time_by_period
from lakeloom.operators.grouping import median_per_key, mode_per_key, one_per_key
from lakeloom.plans import dimensions, facts, silver
from lakeloom.registry import query

DAY = date(2000, 1, 1)


@query(
    "F1_trailing_window",
    """select order_id, order_purchase_timestamp from s_orders
       where order_purchase_timestamp between date '2000-01-01' - 365 and date '2000-01-01'""",
)
def trailing_window(star):
    return star.orders.where(dimensions.in_trailing_window("order_purchase_timestamp", DAY)).select(
        "order_id", "order_purchase_timestamp"
    )


@query("F2_current_versions", "select * from d_seller where is_current")
def current_versions(star):
    return star.dim_seller.where("is_current")


@query("F3_known_members", "select * from f_items where date_sk <> -1 and customer_sk <> '-1'")
def known_members(star):
    return star.fct_order_items.where((F.col("date_sk") != UNKNOWN_DATE_KEY) & (F.col("customer_sk") != UNKNOWN_KEY))


@query("F4_delivered_only", "select order_id, order_value from f_orders where is_delivered = 1")
def delivered_only(star):
    return star.fct_orders.where("is_delivered = 1").select("order_id", "order_value")


CHANGES = """
    select n.seller_id, c.seller_segment as before, n.seller_segment as after
    from (select * from seller_snapshots where as_of = date '1997-01-01') c
    join (select * from seller_snapshots where as_of = date '1998-01-01') n using (seller_id)
    where c.seller_zip_code_prefix is distinct from n.seller_zip_code_prefix
       or c.seller_city is distinct from n.seller_city or c.seller_state is distinct from n.seller_state
       or c.seller_segment is distinct from n.seller_segment
"""


def _two_snapshots(star):
    """First load and next snapshot as ``cur`` and ``new``."""
    first, second = star.rules.snapshot_dates[:2]
    stacked, spec = star.seller_snapshots, dimensions.SELLER_HISTORY
    current = history.first_load(stacked.where(stacked.as_of == first), spec).alias("cur")
    candidate = history.open_versions(stacked.where(stacked.as_of == second), spec, second).alias("new")
    return current, candidate


@query("F5_null_safe_change", CHANGES)
def null_safe_change(star):
    current, candidate = _two_snapshots(star)
    same_seller = F.col("cur.seller_id") == F.col("new.seller_id")
    return (
        candidate.join(current, same_seller)
        .where(history.changed(dimensions.SELLER_HISTORY, "cur", "new"))
        .select("new.seller_id", F.col("cur.seller_segment").alias("before"), F.col("new.seller_segment").alias("after"))
    )


@query(
    "F6_in_list",
    "select zip_code_prefix, state from s_geolocation where state in ('SP', 'RJ', 'MG', 'ES', 'BA')",
)
def in_list(star):
    return star.geolocation.where(F.col("state").isin("SP", "RJ", "MG", "ES", "BA")).select("zip_code_prefix", "state")


@query(
    "F7_violation_predicate",
    """select cohort_year_month, clientes_cohorte, recompra_3m, recompra_6m, recompra_12m from m_cohortes
       where recompra_3m > clientes_cohorte or recompra_6m > clientes_cohorte or recompra_12m > clientes_cohorte
          or recompra_3m > recompra_6m or recompra_6m > recompra_12m""",
)
def violation_predicate(star):
    return quality.cohort_violations(star.plan("mart_cohortes"))


@query(
    "F8_bounding_box",
    "select zip_code_prefix, lat, lng from geo_points where lat not between 0 and 9000 or lng not between -9000 and 0",
)
def bounding_box(star):
    return quality.outside_box(
        silver.geolocation_points(star.raw.geolocation), lat=(0, 9000), lng=(-9000, 0)
    ).select("zip_code_prefix", "lat", "lng")


@query(
    "J1_customers_purchases",
    """select customer_id, customer_unique_id, order_purchase_timestamp
       from raw_customers left join s_orders using (customer_id, customer_unique_id)""",
)
def customers_purchases(star):
    bought = star.orders.select("customer_id", "order_purchase_timestamp")
    return star.raw.customers.join(bought, "customer_id", "left").select(
        "customer_id", "customer_unique_id", "order_purchase_timestamp"
    )


@query("J2_identity_bridge", "select order_id, customer_id, customer_unique_id from s_orders")
def identity_bridge(star):
    return star.raw.orders.join(silver.identity(star.raw.customers), "customer_id", "left").select(
        "order_id", "customer_id", "customer_unique_id"
    )


@query("J3_category_translation", "select product_id, product_category_name, product_category_name_english from s_products")
def category_translation(star):
    return star.plan("products").select("product_id", "product_category_name", "product_category_name_english")


@query("J4_median_and_mode", "select zip_code_prefix, latitude, city from s_geolocation")
def median_and_mode(star):
    points = silver.geolocation_points(star.raw.geolocation)
    medians = median_per_key(points, ["zip_code_prefix"], latitude=F.col("lat"))
    modes = mode_per_key(points, ["zip_code_prefix"], ["city", "state"])
    return medians.join(modes, "zip_code_prefix", "left").select("zip_code_prefix", "latitude", "city")


@query(
    "J5_customer_first_purchase",
    """select customer_unique_id, first_purchase_date, cohort_year_month
       from s_customers left join first_purchases using (customer_unique_id)""",
)
def customer_first_purchase(star):
    first = dimensions.first_purchases(star.orders)
    return star.customers.join(first, "customer_unique_id", "left").select(
        "customer_unique_id", "first_purchase_date", "cohort_year_month"
    )


@query("J6_seller_snapshot", "select * exclude (as_of) from seller_snapshots where as_of = date '2000-01-01'")
def seller_snapshot(star):
    return star.seller_snapshot(DAY)


@query("J7_change_detection", f"select count(*) as changed, count(distinct after) as segments from ({CHANGES})")
def change_detection(star):
    current, candidate = _two_snapshots(star)
    differs = history.changed(dimensions.SELLER_HISTORY, "cur", "new")
    joined = candidate.join(current, (F.col("cur.seller_id") == F.col("new.seller_id")) & differs)
    return joined.agg(F.count("*").alias("changed"), F.count_distinct("new.seller_segment").alias("segments"))


@query(
    "J8_merge_match",
    """select seller_id, seller_segment, valid_from,
              case when valid_to < date '1998-01-01' then valid_to else date '9999-12-31' end as valid_to,
              valid_to >= date '1998-01-01' as is_current
       from d_seller where valid_from <= date '1998-01-01'""",
)
def merge_match(star):
    first, second = star.rules.snapshot_dates[:2]
    stacked, spec = star.seller_snapshots, dimensions.SELLER_HISTORY
    loaded = history.first_load(stacked.where(stacked.as_of == first), spec)
    return history.merge_snapshot(loaded, stacked.where(stacked.as_of == second), spec, second).select(
        "seller_id", "seller_segment", "valid_from", "valid_to", "is_current"
    )


@query("J9_dimension_lookups", "select order_id, customer_sk, geography_sk from order_keys")
def dimension_lookups(star):
    known = facts.buyers(star.dim_customer, star.dim_geography)
    found = star.orders.join(known, "customer_unique_id", "left")
    return found.select("order_id", *[resolve_key(key).alias(key) for key in ("customer_sk", "geography_sk")])


@query(
    "J10_point_in_time",
    """select order_id, order_item_id, i.seller_id, seller_segment
       from s_items i join s_orders using (order_id)
       left join d_seller v on v.seller_id = i.seller_id
            and cast(order_purchase_timestamp as date) between valid_from and valid_to""",
)
def as_of_interval(star):
    bought = star.orders.select("order_id", F.to_date("order_purchase_timestamp").alias("bought_on"))
    sales = star.order_items.select("order_id", "order_item_id", "seller_id").join(bought, "order_id")
    return point_in_time(sales, star.dim_seller, "seller_id", "bought_on", ["seller_segment"]).drop("bought_on")


@query(
    "J10_long_history",
    """with placed as (select l_suppkey, l_orderkey, l_linenumber, cast(l_shipdate as date) as day, l_extendedprice from lineitem),
            changes as (select l_suppkey, day, max(l_extendedprice) as price from placed where l_orderkey % 3 = 0 group by all),
            versions as (select l_suppkey, price, case when row_number() over w = 1 then date '1900-01-01' else day end as valid_from,
                                coalesce(lead(day) over w - 1, date '9999-12-31') as valid_to
                         from changes window w as (partition by l_suppkey order by day))
       select cast(l_orderkey as varchar) as order_id, l_linenumber as line, cast(p.l_suppkey as varchar) as seller_id, price as list_price
       from placed p left join versions v on p.l_suppkey = v.l_suppkey and day between valid_from and valid_to""",
)
def long_history(star):
    """The price list of a seller, which changes with a third of its sales, at each sale."""
    lines = star.raw.given("lineitem")
    sales = lines.select(
        F.col("l_orderkey").cast("string").alias("order_id"), F.col("l_linenumber").alias("line"),
        F.col("l_suppkey").cast("string").alias("seller_id"), F.to_date("l_shipdate").alias("day"), "l_orderkey", "l_extendedprice",
    )
    changes = sales.where("l_orderkey % 3 = 0").groupBy("seller_id", "day").agg(F.max("l_extendedprice").alias("list_price"))
    of_seller = Window.partitionBy("seller_id").orderBy("day")
    history = changes.select(
        "seller_id",
        "list_price",
        F.when(F.row_number().over(of_seller) == 1, F.lit(NO_BEGINNING)).otherwise(F.col("day")).alias("valid_from"),
        F.coalesce(F.date_sub(F.lead("day").over(of_seller), 1), F.lit(date(9999, 12, 31))).alias("valid_to"),
    )
    found = point_in_time_by_period(sales, history, "seller_id", "day", ["list_price"])
    return found.select("order_id", "line", "seller_id", "list_price")


@query("J11_drill_across", "select order_id, order_item_count, order_value from f_orders")
def drill_across(star):
    totals = facts.order_totals(star.order_items)
    nothing = F.lit(0).cast("decimal(12,2)")
    return star.orders.join(totals, "order_id", "left").select(
        "order_id",
        F.coalesce("order_item_count", F.lit(0)).alias("order_item_count"),
        F.coalesce("order_value", nothing).alias("order_value"),
    )


@query(
    "J12_bridge_to_orders",
    """select order_id, payment_sequential, customer_unique_id, order_purchase_timestamp
       from s_payments left join s_orders using (order_id)""",
)
def bridge_to_orders(star):
    bridge = star.orders.select("order_id", "customer_unique_id", "order_purchase_timestamp")
    return star.payments.select("order_id", "payment_sequential").join(bridge, "order_id", "left")


@query(
    "J13_star_join",
    """select order_id, order_item_id, year_month, product_category_name_english, seller_segment
       from f_items join d_date using (date_sk) join d_product using (product_sk) join d_seller using (seller_sk)""",
)
def star_join(star):
    return (
        join_on_digest(star.fct_order_items.join(star.dim_seller, "seller_sk"), star.dim_product, "product_sk")
        .join(star.dim_date, "date_sk")
        .select("order_id", "order_item_id", "year_month", "product_category_name_english", "seller_segment")
    )


@query("J14_facts_at_order_grain", "select review_id, order_id, days_late, review_score from f_orders join f_reviews using (order_id)")
def facts_at_order_grain(star):
    return star.fct_reviews.join(star.fct_orders, "order_id").select(
        "review_id", "order_id", "days_late", "review_score"
    )


@query(
    "J15_orphans",
    """select order_id, order_item_id, product_id from s_items
       where product_id not in (select product_id from s_products)""",
)
def orphans(star):
    return quality.orphans(star.order_items, "product_id", star.products, "product_id").select(
        "order_id", "order_item_id", "product_id"
    )


@query(
    "J16_mean_and_median",
    """select zip_code_prefix, mean_lat, latitude, round(abs(mean_lat - latitude), 4) as gap
       from s_geolocation join (select zip_code_prefix, cast(sum(cast(lat as decimal(12,2))) as double) / count(lat) as mean_lat
                                from geo_points group by 1) using (zip_code_prefix)""",
)
def mean_and_median(star):
    points = silver.geolocation_points(star.raw.geolocation)
    means = points.groupBy("zip_code_prefix").agg(A.exact_avg(F.col("lat").cast("decimal(12,2)")).alias("mean_lat"))
    medians = median_per_key(points, ["zip_code_prefix"], latitude=F.col("lat"))
    return means.join(medians, "zip_code_prefix").select(
        "zip_code_prefix", "mean_lat", "latitude", F.round(F.abs(F.col("mean_lat") - F.col("latitude")), 4).alias("gap")
    )


@query("L1_ordered_mart", "select cohort_year_month, clientes_cohorte from m_cohortes order by 1")
def ordered_mart(star):
    return star.mart_cohortes.select("cohort_year_month", "clientes_cohorte").orderBy("cohort_year_month")


@query(
    "L3_top_one_per_group",
    """select seller_id, order_id, price from s_items
       qualify row_number() over (partition by seller_id order by price desc nulls last, order_id desc, order_item_id desc) = 1""",
)
def top_one_per_group(star):
    best = F.max_by(F.struct("order_id", "price"), F.struct("price", "order_id", "order_item_id")).alias("best")
    return star.order_items.groupBy("seller_id").agg(best).select("seller_id", "best.*")


@query("L4_scalar", "select max(order_purchase_timestamp) as last_purchase, count(*) as row_count from s_orders")
def scalar(star):
    return star.orders.agg(F.max("order_purchase_timestamp").alias("last_purchase"), F.count("*").alias("row_count"))


@query(
    "U1_union_unknown",
    """select seller_id, seller_segment, gmv_window from seller_snapshots where as_of = date '1999-01-01'""",
)
def union_unknown(star):
    return star.seller_snapshot(date(1999, 1, 1)).select("seller_id", "seller_segment", "gmv_window")


@query(
    "U2_close_and_open",
    f"""select seller_id, before as segment, date '1997-12-31' as valid_to from ({CHANGES})
        union all select seller_id, after, date '9999-12-31' from ({CHANGES})""",
)
def close_and_open(star):
    """Both rows of every changed member: the one that ends and the one that begins."""
    first, second = star.rules.snapshot_dates[:2]
    stacked, spec = star.seller_snapshots, dimensions.SELLER_HISTORY
    loaded = history.first_load(stacked.where(stacked.as_of == first), spec)
    merged = history.merge_snapshot(loaded, stacked.where(stacked.as_of == second), spec, second)
    touched = (F.col("valid_to") == second - timedelta(days=1)) | (F.col("valid_from") == second)
    return merged.where(touched).select("seller_id", F.col("seller_segment").alias("segment"), "valid_to")


@query("U3_key_dedup", "select distinct review_id, order_id, review_score from raw_reviews")
def key_dedup(star):
    return one_per_key(star.raw.reviews.select("review_id", "order_id", "review_score"), ["review_id", "order_id"])


@query(
    "S9_unknown_rows",
    """select 'dim_customer' as dimension, count(*) as members, count(*) filter (where customer_sk = '-1') as unknown from d_customer
       union all select 'dim_product', count(*), count(*) filter (where product_sk = '-1') from d_product
       union all select 'dim_geography', count(*), count(*) filter (where geography_sk = '-1') from d_geography
       union all select 'dim_date', count(*), count(*) filter (where date_sk = -1) from d_date""",
)
def unknown_rows(star):
    keyed = {"dim_customer": "customer_sk", "dim_product": "product_sk", "dim_geography": "geography_sk", "dim_date": "date_sk"}
    counted = [
        star.table(name).agg(
            F.lit(name).alias("dimension"),
            F.count("*").alias("members"),
            F.count_if(F.col(key).cast("string") == UNKNOWN_KEY).alias("unknown"),
        )
        for name, key in keyed.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counted)


@query(
    "S10_calendar_days",
    """select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as full_date
       from (select cast(min(order_purchase_timestamp) as date)::timestamp as lo,
                    cast(max(order_purchase_timestamp) as date)::timestamp as hi from s_orders)""",
)
def calendar_days(star):
    bounds = star.orders.agg(
        F.to_date(F.min("order_purchase_timestamp")).alias("lo"), F.to_date(F.max("order_purchase_timestamp")).alias("hi")
    )
    return dimensions.days(bounds, F.col("lo"), F.col("hi"))


@query(
    "S7_source_views",
    """select year_month, sum(price) as gmv from f_items join d_date using (date_sk) where date_sk <> -1 group by 1""",
)
def source_views(star):
    """Gold tables under their names, queried as SQL text."""
    for name in ("fct_order_items", "dim_date"):
        star.table(name).createOrReplaceTempView(f"gold_{name}")
    return star.spark.sql(
        """select year_month, cast(sum(price) as decimal(38,2)) as gmv
           from gold_fct_order_items join gold_dim_date using (date_sk) where date_sk <> -1 group by 1"""
    )


@query("S8_model_reference", "select cohort_year_month from m_cohortes where recompra_3m > recompra_6m")
def model_reference(star):
    """A mart registered after the gold views it reads, then tested by its name."""
    star.mart_cohortes.createOrReplaceTempView("mart_cohortes")
    return star.spark.sql("select cohort_year_month from mart_cohortes where recompra_3m > recompra_6m")

