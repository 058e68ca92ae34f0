"""Snapshots, versions, history loads and layer builds."""

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators import history
from lakeloom.operators.dimension import as_of_date
from lakeloom.plans import build, dimensions, monthly
from lakeloom.plans.dimensions import SELLER_HISTORY
from lakeloom.plans.star import Star
from lakeloom.registry import query
from lakeloom.registry.oracle import exact_avg
from lakeloom.session import working_folder
from lakeloom.sources import tables

RECENT = date(2001, 1, 1)


def _at(star: Star, day: date) -> DataFrame:
    stacked = star.seller_snapshots
    return stacked.where(stacked.as_of == day).drop("as_of")


def _loads(star: Star) -> tuple[str, dict[date, dict[str, int]]]:
    """All snapshot dates loaded one after the other into a table of their own."""
    root = working_folder(star.spark, "history")
    done = {
        day: build.load_history(root, "dim_seller", _at(star, day), SELLER_HISTORY, day)
        for day in star.rules.snapshot_dates
    }
    return root, done


@query("C1_seller_snapshot", "select * exclude (as_of) from seller_snapshots where as_of = date '2001-01-01'")
def seller_snapshot(star):
    return star.seller_snapshot(RECENT)


@query("F1_snapshot_by_month", "select * exclude (as_of) from seller_snapshots where as_of = date '2001-01-01'")
def snapshot_by_month(star):
    """The snapshot again, from tables by month, of which it lists thirteen."""
    return monthly.seller_snapshot(star, _monthly(star), RECENT)


# Tables by month of a warehouse as loaded and as changed; as all of its tables they are built once in an application.
_BY_MONTH: dict[tuple[str, str], str] = {}


def _monthly(star: Star, state: str = "loaded") -> str:
    if (star.root, state) not in _BY_MONTH:
        root = working_folder(star.spark, f"monthly-{state}")
        monthly.first_load(star, root)
        for change_set in _change_sets(star) if state == "changed" else ():
            monthly.apply_changes(star, root, *change_set)
        _BY_MONTH[star.root, state] = root
    return _BY_MONTH[star.root, state]


def _change_sets(star: Star):
    """(orders, items, payments, reviews) of three change sets: dearer, shorter and new orders."""
    orders, items, payments, reviews = star.orders, star.order_items, star.payments, star.reviews
    bought, number = F.date_format("order_purchase_timestamp", "yyyy-MM"), F.col("order_id").cast("int")
    dearer = orders.where(bought.isin("1998-01", "1998-02", "1998-03") & (number % 50 == 1))
    more = lambda df, column: df.withColumn(column, (F.col(column) + 1).cast(df.schema[column].dataType))
    yield dearer, more(items, "price"), more(payments, "payment_value"), reviews.withColumn("review_score", F.lit(1))
    shorter = orders.where((bought == "1998-02") & (number % 50 == 2))
    yield shorter, items.where("order_item_id <> 1"), None, None
    again = F.concat("order_id", F.lit("-new")).alias("order_id")
    new = orders.where((bought == "1998-03") & (number % 100 == 3))
    yield tuple(df.withColumn("order_id", again) for df in (new, items, payments, reviews))


def _changed(star: Star) -> str:
    return _monthly(star, "changed")


# The items of the facts as the change sets leave them.
_CHANGED_ITEMS = """
    changed_items as (
        select * replace (case when dearer then price + 1 else price end as price, case when dearer then gross_revenue + 1 else gross_revenue end as gross_revenue)
        from (select *, date_sk // 100 in (199801, 199802, 199803) and order_id::int % 50 = 1 as dearer from f_items)
        where not coalesce(date_sk // 100 = 199802 and order_id::int % 50 = 2 and order_item_id = 1, false)
        union all select * replace (order_id || '-new' as order_id), false from f_items where date_sk // 100 = 199803 and order_id::int % 100 = 3
    )"""


@query(
    "X16_incremental_marts",
    f"""with {_CHANGED_ITEMS}
        select year_month, year, coalesce(product_category_name_english, 'Sin categoria') as product_category,
               sum(price) as gmv, sum(freight_value) as ingreso_flete, sum(gross_revenue) as ingreso_bruto,
               sum(price) - sum(freight_value) as margen_contribucion,
               cast(sum(item_count) as bigint) as items_vendidos, count(distinct order_id) as ordenes
        from changed_items join d_product using (product_sk) join d_date using (date_sk) where date_sk <> -1 group by 1, 2, 3""",
)
def incremental_marts(star):
    """The mart by category after three change sets, each of which has read and written its months alone."""
    return monthly.read(star.spark, _changed(star), "mart_ventas_categoria").drop(monthly.MONTH)


@query(
    "X16_incremental_segments",
    f"""with {_CHANGED_ITEMS}
        select year_month, seller_segment, sum(price) as gmv, count(order_item_id) as items_vendidos, count(distinct order_id) as ordenes
        from changed_items join d_seller using (seller_sk) join d_date using (date_sk) where date_sk <> -1 group by 1, 2""",
)
def incremental_segments(star):
    return monthly.read(star.spark, _changed(star), "mart_segmento_vendedor").drop(monthly.MONTH)


# The orders, payments and reviews of the facts as the change sets leave them.
_CHANGED_ORDERS = f"""{_CHANGED_ITEMS},
    totals as (select order_id, count(*) as n, sum(gross_revenue) as value from changed_items group by 1),
    changed_orders as (
        select f.* replace (coalesce(n, 0) as order_item_count, coalesce(value, 0) as order_value) from f_orders f left join totals using (order_id)
        union all
        select f.* replace (order_id || '-new' as order_id) from f_orders f where purchase_date_sk // 100 = 199803 and order_id::int % 100 = 3)"""
_CHANGED_REVIEWS = """
    changed_reviews as (
        select r.* replace (case when dearer then 1 else review_score end as review_score,
                            case when dearer then 1 else is_negative end as is_negative, case when dearer then 0 else is_positive end as is_positive)
        from f_reviews r left join (
            select order_id, true as dearer from f_orders where purchase_date_sk // 100 in (199801, 199802, 199803) and order_id::int % 50 = 1) using (order_id)
        union all
        select r.* replace (r.order_id || '-new' as order_id) from f_reviews r
        join f_orders o on o.order_id = r.order_id and purchase_date_sk // 100 = 199803 and r.order_id::int % 100 = 3)"""


@query("X16_incremental_orders", f"with {_CHANGED_ORDERS} select * from changed_orders")
def incremental_orders(star):
    return monthly.read(star.spark, _changed(star), "fct_orders").drop(monthly.MONTH)


@query(
    "X16_incremental_payments",
    """select * replace (case when date_sk // 100 in (199801, 199802, 199803) and order_id::int % 50 = 1 then payment_value + 1 else payment_value end as payment_value)
       from f_payments
       union all
       select * replace (order_id || '-new' as order_id) from f_payments where date_sk // 100 = 199803 and order_id::int % 100 = 3""",
)
def incremental_payments(star):
    return monthly.read(star.spark, _changed(star), "fct_payments").drop(monthly.MONTH)


@query("X16_incremental_reviews", f"with {_CHANGED_REVIEWS} select * from changed_reviews")
def incremental_reviews(star):
    return monthly.read(star.spark, _changed(star), "fct_reviews").drop(monthly.MONTH)


@query(
    "X16_incremental_satisfaction",
    f"""with {_CHANGED_ORDERS}, {_CHANGED_REVIEWS}
        select year_month, case when is_late = 0 then 'a tiempo' when days_late <= 3 then '1-3 dias'
                                when days_late <= 7 then '4-7 dias' else '>7 dias' end as tramo_retraso,
               cast(sum(review_count) as bigint) as reviews, cast(sum(is_negative) as bigint) as reviews_negativas,
               cast(sum(is_positive) as bigint) as reviews_positivas, {exact_avg("review_score")} as score_medio,
               {exact_avg("response_time_hours")} as tiempo_respuesta_medio_h, {exact_avg("days_late")} as retraso_medio_dias
        from changed_orders join changed_reviews using (order_id) join d_date on purchase_date_sk = d_date.date_sk
        where d_date.date_sk <> -1 and is_delivered = 1 group by 1, 2""",
)
def incremental_satisfaction(star):
    return monthly.read(star.spark, _changed(star), "mart_satisfaccion").drop(monthly.MONTH)


@query(
    "X16_incremental_cohorts",
    f"""with {_CHANGED_ORDERS},
        changed_activity as (
            select cohort_year_month, customer_sk, order_value,
                   (year(full_date) - year(first_purchase_date)) * 12 + month(full_date) - month(first_purchase_date) as relative_month
            from changed_orders join d_customer using (customer_sk) join d_date on purchase_date_sk = date_sk
            where date_sk <> -1 and customer_sk <> '-1')
        select cohort_year_month, count(distinct customer_sk) as clientes_cohorte,
               count(distinct customer_sk) filter (where relative_month between 1 and 3) as recompra_3m,
               count(distinct customer_sk) filter (where relative_month between 1 and 6) as recompra_6m,
               count(distinct customer_sk) filter (where relative_month between 1 and 12) as recompra_12m,
               sum(order_value) as gmv_acumulado, sum(order_value) filter (where relative_month = 0) as gmv_primera_compra
        from changed_activity group by 1""",
)
def incremental_cohorts(star):
    """The mart of cohorts after three change sets, each of which has read and written the cohorts of its customers alone."""
    return monthly.read(star.spark, _changed(star), "mart_cohortes").drop(monthly.MONTH)


@query(
    "C2_new_versions",
    """select case when seller_id = '-1' then '-1' else sha256(seller_id || '|2001-01-01') end as seller_sk,
       * exclude (as_of), as_of as valid_from, date '9999-12-31' as valid_to, true as is_current
       from seller_snapshots where as_of = date '2001-01-01'""",
)
def new_versions(star):
    return history.open_versions(_at(star, RECENT), SELLER_HISTORY, RECENT)


@query(
    "C3_history_load",
    """select valid_from as as_of, count(*) as inserted,
       (select count(*) from d_seller c where c.valid_to = o.valid_from - 1) as closed from d_seller o
       where valid_from > date '1900-01-01' group by valid_from""",
)
def history_load(star):
    """What each load after the first reports."""
    _, done = _loads(star)
    later = [(day, counts["inserted"], counts["closed"]) for day, counts in done.items() if day > min(done)]
    return star.spark.createDataFrame(later, "as_of date, inserted bigint, closed bigint")


@query("K5_history_merge", "select * from d_seller")
def history_merge(star):
    root, _ = _loads(star)
    return tables.read_table(star.spark, root, "dim_seller")


@query(
    "K6_history_first_load",
    """select case when seller_id = '-1' then '-1' else sha256(seller_id || '|1900-01-01') end as seller_sk,
       * exclude (as_of), date '1900-01-01' as valid_from, date '9999-12-31' as valid_to, true as is_current
       from seller_snapshots where as_of = date '1997-01-01'""",
)
def history_first_load(star):
    root = working_folder(star.spark, "history")
    first = min(star.rules.snapshot_dates)
    build.load_history(root, "dim_seller", _at(star, first), SELLER_HISTORY, first)
    return tables.read_table(star.spark, root, "dim_seller")


@query("L2_last_load", "select max(valid_from) as last_load, count(*) filter (where is_current) as members from d_seller")
def last_load(star):
    root, _ = _loads(star)
    loaded = tables.read_table(star.spark, root, "dim_seller")
    return loaded.agg(F.max("valid_from").alias("last_load"), F.count_if("is_current").alias("members"))


@query(
    "C4_layer_build",
    """select 'customers' as table_name, count(*) as row_count from s_customers
       union all select 'sellers', count(*) from s_sellers union all select 'products', count(*) from s_products
       union all select 'geolocation', count(*) from s_geolocation union all select 'orders', count(*) from s_orders
       union all select 'order_items', count(*) from s_items union all select 'payments', count(*) from s_payments
       union all select 'reviews', count(*) from s_reviews union all select 'dim_date', count(*) from d_date
       union all select 'dim_customer', count(*) from d_customer union all select 'dim_product', count(*) from d_product
       union all select 'dim_geography', count(*) from d_geography
       union all select 'seller_snapshots', count(*) from seller_snapshots
       union all select 'dim_seller', count(*) from d_seller union all select 'fct_orders', count(*) from f_orders
       union all select 'fct_order_items', count(*) from f_items union all select 'fct_payments', count(*) from f_payments
       union all select 'fct_reviews', count(*) from f_reviews""",
)
def layer_build(star):
    """Silver then gold, built into a place of their own; counts are read back from what is published."""
    root = working_folder(star.spark, "warehouse")
    own = Star(star.raw, star.rules, root)
    built = [name for layer in ("silver", "gold") for name in build.build_layer(own, layer)]
    counted = [own.table(n).agg(F.lit(n).alias("table_name"), F.count("*").alias("row_count")) for n in built]
    return reduce(DataFrame.unionByName, counted)


@query(
    "X18_point_in_time_view",
    "select * from d_seller where date '1999-06-30' between valid_from and valid_to",
)
def point_in_time_view(star):
    return as_of_date(star.dim_seller, date(1999, 6, 30))



RUN_DAYS = [date(1999, 1, 1), date(2000, 1, 1), date(2001, 1, 1)]


@query(
    "G5_daily_runs",
    """with run_days(as_of, n) as (values (date '1999-01-01', 1), (date '2000-01-01', 2), (date '2001-01-01', 3)),
            places as (
                select as_of, seller_id, seller_zip_code_prefix, seller_state,
                       case when seller_id like '%' || n then seller_city || ' ' || n else seller_city end as seller_city
                from s_sellers cross join run_days where not (n = 2 and seller_id like '%7')
                union all by name select as_of, '-1' as seller_id, 'Unknown' as seller_zip_code_prefix, 'Unknown' as seller_state,
                       'Unknown' as seller_city from run_days),
            sold as (select as_of, seller_id, sum(price) as gmv from s_items join s_orders using (order_id)
                     join run_days on order_purchase_timestamp between as_of - 365 and as_of group by all),
            days_seen as (
                select as_of, seller_id, seller_zip_code_prefix, seller_city, seller_state, coalesce(gmv, 0) as gmv_window,
                       case when seller_id = '-1' then 'Unknown' when gmv > 5200000 then 'Gold' when gmv >= 4500000 then 'Silver'
                            else 'Bronze' end as seller_segment
                from places left join sold using (as_of, seller_id)),
            opened as (
                select * from days_seen window w as (partition by seller_id order by as_of)
                qualify row_number() over w = 1 or seller_city is distinct from lag(seller_city) over w
                     or seller_segment is distinct from lag(seller_segment) over w)
       select case when seller_id = '-1' then '-1' else sha256(seller_id || '|' || valid_from) end as seller_sk, seller_id,
              seller_zip_code_prefix, seller_city, seller_state, seller_segment, gmv_window, valid_from, valid_to,
              valid_to = date '9999-12-31' as is_current
       from (select *, coalesce(lead(as_of) over (partition by seller_id order by as_of) - 1, date '9999-12-31') as valid_to,
                    case when as_of = date '1999-01-01' then date '1900-01-01' else as_of end
                    as valid_from from opened)""",
)
def daily_runs(star):
    """Three days, one run each: some sellers move, some change their segment, some are absent on the second day."""
    root = working_folder(star.spark, "days")
    for number, day in enumerate(RUN_DAYS, 1):
        seller, city = F.col("seller_id"), F.col("seller_city")
        moved = F.when(seller.endswith(str(number)), F.concat(city, F.lit(f" {number}"))).otherwise(city)
        present = star.sellers.where(~seller.endswith("7")) if number == 2 else star.sellers
        snapshot = dimensions.seller_snapshot(
            present.withColumn("seller_city", moved), star.order_items, star.orders, day, **star.rules.segments
        )
        build.load_history(root, "dim_seller", snapshot, SELLER_HISTORY, day)
    return tables.read_table(star.spark, root, "dim_seller")
