"""Canonical metrics over the published star."""

from pyspark.sql import functions as F

from lakeloom.plans import marts
from lakeloom.plans import metrics as M
from lakeloom.registry import query


def _items_by_year(star):
    return star.fct_order_items.join(star.dim_date.select("date_sk", "year", "year_month"), "date_sk")


def _orders_by_day(star):
    days = star.dim_date.select(F.col("date_sk").alias("purchase_date_sk"), "year", "year_month")
    return star.fct_orders.join(days, "purchase_date_sk")


def _orders_by_place(star):
    return star.fct_orders.join(star.dim_geography.select("geography_sk", "region"), "geography_sk")


REVENUE = "select year, sum({}) as {} from f_items join d_date using (date_sk) group by 1"


@query("B1_gmv", REVENUE.format("price", "gmv"))
def gmv(star):
    return M.revenue(_items_by_year(star), ["year"]).select("year", "gmv")


@query("B2_gross_revenue", REVENUE.format("gross_revenue", "gross_revenue"))
def gross_revenue(star):
    return M.revenue(_items_by_year(star), ["year"]).select("year", "gross_revenue")


@query("B3_freight_revenue", REVENUE.format("freight_value", "freight_revenue"))
def freight_revenue(star):
    return M.revenue(_items_by_year(star), ["year"]).select("year", "freight_revenue")


@query(
    "B4_average_ticket",
    """select year_month, count(distinct order_id) as orders,
       cast(sum(order_value) as double) / count(distinct order_id) as average_ticket
       from f_orders join d_date on date_sk = purchase_date_sk group by 1""",
)
def average_ticket(star):
    return M.average_ticket(_orders_by_day(star), ["year_month"])


@query(
    "B5_late_share",
    """select region, cast(sum(is_late) as bigint) as late, cast(sum(is_delivered) as bigint) as delivered,
       cast(sum(is_late) as double) / nullif(sum(is_delivered), 0) as late_share
       from f_orders join d_geography using (geography_sk) group by 1""",
)
def late_share(star):
    return M.late_share(_orders_by_place(star), ["region"]).drop("mean_delay")


@query(
    "B6_mean_delay",
    """select region, cast(sum(days_late) filter (where is_late = 1) as double) / nullif(count(*) filter (where is_late = 1), 0)
       as mean_delay from f_orders join d_geography using (geography_sk) group by 1""",
)
def mean_delay(star):
    return M.late_share(_orders_by_place(star), ["region"]).select("region", "mean_delay")


@query(
    "B7_repurchase_rate",
    """select cohort_year_month, recompra_3m / clientes_cohorte as rate_3m, recompra_6m / clientes_cohorte as rate_6m,
       recompra_12m / clientes_cohorte as rate_12m from m_cohortes""",
)
def repurchase_rate(star):
    return M.repurchase_rates(star.mart_cohortes)


REVIEWS = """select customer_state, {} from f_reviews join d_customer using (customer_sk) group by 1"""


def _reviews_by_state(star):
    return star.fct_reviews.join(star.dim_customer.select("customer_sk", "customer_state"), "customer_sk")


@query("B8_mean_score", REVIEWS.format("cast(sum(review_score) as double) / count(review_score) as mean_score"))
def mean_score(star):
    return M.review_scores(_reviews_by_state(star), ["customer_state"]).select("customer_state", "mean_score")


@query("B9_negative_share", REVIEWS.format("cast(sum(is_negative) as double) / count(*) as negative_share"))
def negative_share(star):
    return M.review_scores(_reviews_by_state(star), ["customer_state"]).select("customer_state", "negative_share")


@query("B10_gmv_by_segment", "select seller_segment, sum(gmv) as gmv from m_segmento group by 1")
def gmv_by_segment(star):
    return M.segment_gmv(star.mart_segmento_vendedor)


@query(
    "B11_lifetime_value",
    "select cohort_year_month, cast(gmv_acumulado as double) / clientes_cohorte as ltv from m_cohortes",
)
def lifetime_value(star):
    return M.lifetime_value(star.mart_cohortes)


@query(
    "B11_ltv_windows",
    "select cohort_year_month, count(distinct customer_sk) as customers, "
    + ", ".join(
        f"cast(coalesce(sum(order_value) filter (where relative_month <= {n}), 0) as double) / count(distinct customer_sk) as ltv_{n}m"
        for n in (3, 6, 12)
    )
    + " from activity group by 1",
)
def ltv_windows(star):
    return M.lifetime_windows(marts.order_activity(star.fct_orders, star.dim_customer, star.dim_date))
