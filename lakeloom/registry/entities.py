"""Whole tables: silver entities, gold dimensions and facts, marts."""

from datetime import date
from functools import reduce

from lakeloom.operators.history import first_load, merge_snapshot
from lakeloom.plans import dimensions
from lakeloom.plans.dimensions import SELLER_HISTORY
from lakeloom.registry import query


@query("E1_customers", "select * from s_customers")
def customers(star):
    return star.plan("customers")


@query("E2_sellers", "select * from s_sellers")
def sellers(star):
    return star.plan("sellers")


@query("E3_products", "select * from s_products")
def products(star):
    return star.plan("products")


@query("E4_geolocation", "select * from s_geolocation")
def geolocation(star):
    return star.plan("geolocation")


@query("E5_orders", "select * from s_orders")
def orders(star):
    return star.plan("orders")


@query("E6_order_items", "select * from s_items")
def order_items(star):
    return star.plan("order_items")


@query("E7_payments", "select * from s_payments")
def payments(star):
    return star.plan("payments")


@query("E8_reviews", "select * from s_reviews")
def reviews(star):
    return star.plan("reviews")


@query("G1_dim_date", "select * from d_date")
def dim_date(star):
    return star.plan("dim_date")


@query(
    "G1_dim_date_covering",
    """select d_date.* from d_date,
       (select least(1998, year(min(m))) as lo, greatest(1998, year(max(m))) as hi from (
            select order_purchase_timestamp as m from s_orders union all select order_estimated_delivery_date from s_orders
            union all select order_delivered_customer_date from s_orders union all select review_creation_date from s_reviews))
       where date_sk = -1 or d_date.year between lo and hi""",
)
def dim_date_covering(star):
    """A calendar that is given too short grows to hold every date that becomes a key."""
    return dimensions.dim_date(star.orders, star.reviews, (date(1998, 3, 1), date(1998, 4, 30)))


@query("G2_dim_customer", "select * from d_customer")
def dim_customer(star):
    return star.plan("dim_customer")


@query("G3_dim_product", "select * from d_product")
def dim_product(star):
    return star.plan("dim_product")


@query("G4_dim_geography", "select * from d_geography")
def dim_geography(star):
    return star.plan("dim_geography")


@query("G5_dim_seller", "select * from d_seller")
def dim_seller(star):
    """Merged one snapshot after the other, as the loads would come."""
    first, *later = star.rules.snapshot_dates
    snapshots = star.seller_snapshots

    def at(day: date):
        return snapshots.where(snapshots.as_of == day).drop("as_of")

    return reduce(
        lambda history, day: merge_snapshot(history, at(day), SELLER_HISTORY, day),
        later,
        first_load(at(first), SELLER_HISTORY),
    )


@query("G5_dim_seller_backfill", "select * from d_seller")
def dim_seller_backfill(star):
    """The same history in one pass over all snapshots."""
    return star.plan("dim_seller")


@query("G6_fct_orders", "select * from f_orders")
def fct_orders(star):
    return star.plan("fct_orders")


@query("G7_fct_order_items", "select * from f_items")
def fct_order_items(star):
    return star.plan("fct_order_items")


@query("G8_fct_payments", "select * from f_payments")
def fct_payments(star):
    return star.plan("fct_payments")


@query("G9_fct_reviews", "select * from f_reviews")
def fct_reviews(star):
    return star.plan("fct_reviews")


@query("M1_mart_cohortes", "select * from m_cohortes order by 1")
def mart_cohortes(star):
    return star.plan("mart_cohortes")


@query("M2_mart_satisfaccion", "select * from m_satisfaccion")
def mart_satisfaccion(star):
    return star.plan("mart_satisfaccion")


@query("M3_mart_ventas_categoria", "select * from m_categoria")
def mart_ventas_categoria(star):
    return star.plan("mart_ventas_categoria")


@query("M4_mart_segmento_vendedor", "select * from m_segmento")
def mart_segmento_vendedor(star):
    return star.plan("mart_segmento_vendedor")
