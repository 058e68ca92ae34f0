"""Gold facts.

Customer, place and date of an order are resolved once, in the order fact; the finer facts take
them from there. At item grain that leaves one join on the order, one on the product and one on
the seller version.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions import attributes as A
from lakeloom.functions.constants import UNKNOWN_KEY
from lakeloom.functions.keys import date_key, key_date, packed, resolve_date_key, resolve_key, surrogate_key, unpacked, version_key
from lakeloom.operators.dimension import irregular, version_at, with_exceptions
from lakeloom.session import written

PRIMARY_KEYS = {
    "fct_orders": ["order_id"],
    "fct_order_items": ["order_id", "order_item_id"],
    "fct_payments": ["order_id", "payment_sequential"],
    "fct_reviews": ["review_id", "order_id"],
}


# Columns of each fact in order.
CONTRACTS = {
    "fct_orders": (
        "purchase_date_sk",
        "delivered_date_sk",
        "estimated_date_sk",
        "customer_sk",
        "geography_sk",
        "order_id",
        "order_status",
        "days_to_delivery",
        "days_late",
        "is_delivered",
        "is_late",
        "order_item_count",
        "order_value",
        "order_count",
    ),
    "fct_order_items": (
        "date_sk",
        "customer_sk",
        "seller_sk",
        "product_sk",
        "geography_sk",
        "order_id",
        "order_item_id",
        "price",
        "freight_value",
        "gross_revenue",
        "item_count",
    ),
    "fct_payments": (
        "date_sk",
        "customer_sk",
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_value",
        "payment_installments",
        "payment_count",
    ),
    "fct_reviews": (
        "date_sk",
        "customer_sk",
        "review_id",
        "order_id",
        "review_score",
        "is_negative",
        "is_positive",
        "response_time_hours",
        "review_count",
    ),
}


def as_contracted(fact: str, rows: DataFrame, dates: Mapping[str, str] | None = None, kept: Sequence[str] = (), **measures: Column) -> DataFrame:
    """The columns of a fact: dates keyed from their moments, keys resolved, measures computed, the rest as it is; ``kept`` stand behind."""
    told = {key: date_key(moment) for key, moment in (dates or {}).items()} | measures

    def column(name: str) -> Column:
        if name in told:
            return told[name]
        if name == "date_sk":
            return resolve_date_key(name)
        return resolve_key(name) if name.endswith("_sk") else F.col(name)

    return rows.select(*[column(name).alias(name) for name in CONTRACTS[fact]], *kept)


def buyers(dim_customer: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """Keys of each customer and of the place of delivery, which is where the customer lives.

    The place is looked up per customer, so orders move for their customer alone.
    """
    people = dim_customer.select("customer_unique_id", "customer_sk", "customer_zip_code_prefix")
    places = dim_geography.select(F.col("zip_code_prefix").alias("customer_zip_code_prefix"), "geography_sk")
    return people.join(places, "customer_zip_code_prefix", "left").drop("customer_zip_code_prefix")


def order_totals(items: DataFrame) -> DataFrame:
    """Items rolled up to the order before anything is joined to it."""
    value = F.sum(F.col("price") + F.col("freight_value"))
    return items.groupBy("order_id").agg(F.count("*").alias("order_item_count"), value.alias("order_value"))


def fct_orders(orders: DataFrame, items: DataFrame, dim_customer: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """Orders meet their totals first and their customer last, so the wide keys found there do not move again."""
    known = buyers(dim_customer, dim_geography)
    rows = orders.join(order_totals(items), "order_id", "left").join(known, "customer_unique_id", "left")
    dates = {
        "purchase_date_sk": "order_purchase_timestamp",
        "delivered_date_sk": "order_delivered_customer_date",
        "estimated_date_sk": "order_estimated_delivery_date",
    }
    return as_contracted("fct_orders", rows, dates, **A.order_measures())


def order_keys(fct_orders: DataFrame) -> DataFrame:
    """Resolved keys of each order, for the facts below the order grain.

    They come from the order fact, where customer and place were looked up once; a finer fact
    then moves for the order alone instead of once per dimension of the order.
    """
    return fct_orders.select("order_id", F.col("purchase_date_sk").alias("date_sk"), "customer_sk", "geography_sk")


def items_with_keys(items: DataFrame, fct_orders: DataFrame, dim_product: DataFrame, dim_seller: DataFrame) -> DataFrame:
    """Items with the seller version valid on the day of purchase.

    Items move once, for their order. Keys of products and versions follow from ids and dates, so only the exceptions are
    looked up; the keys found are packed, and rows can move on before ``items_contracted`` ends them.
    """
    of_order, of_version = ("customer_sk", "geography_sk"), ["seller_id", "_since", "_until"]
    versions = dim_seller.select("seller_id", F.col("valid_from").alias("_since"), F.col("valid_to").alias("_until"), "seller_sk")
    own = packed(irregular(versions, of_version, "seller_sk", version_key("seller_id", "_since")), "seller_sk")
    history = versions.select(*of_version, F.col("_since").alias("valid_from"), F.col("_until").alias("valid_to")).distinct()
    enriched = (
        with_exceptions(items, dim_product, "product_id", "product_sk", "_product")
        .join(packed(order_keys(fct_orders), *of_order), "order_id", "left")
        .withColumn("purchase_date", key_date("date_sk"))
    )
    sold = version_at(enriched, history, "seller_id", "purchase_date", of_version[1:])
    return sold.join(written(own, "exceptions"), of_version, "left").drop("_until")


def items_contracted(rows: DataFrame, *kept: str) -> DataFrame:
    """The fact of items, of rows as ``items_with_keys`` gives them, and other columns that go on with it."""
    known = unpacked(rows, "customer_sk", "geography_sk", "seller_sk")
    product = F.coalesce("_product", surrogate_key("product_id"), F.lit(UNKNOWN_KEY))
    version = F.coalesce("seller_sk", version_key("seller_id", "_since"))
    seller = F.when(F.col("_since").isNull(), UNKNOWN_KEY).otherwise(version)
    gross = F.col("price") + F.col("freight_value")
    return as_contracted("fct_order_items", known, kept=kept, product_sk=product, seller_sk=seller, gross_revenue=gross, item_count=F.lit(1))


def fct_order_items(
    items: DataFrame, fct_orders: DataFrame, dim_product: DataFrame, dim_seller: DataFrame
) -> DataFrame:
    """Items with all their keys, which move packed until the fact is written."""
    return items_contracted(items_with_keys(items, fct_orders, dim_product, dim_seller))


def fct_payments(payments: DataFrame, fct_orders: DataFrame) -> DataFrame:
    known = packed(order_keys(fct_orders).drop("geography_sk"), "customer_sk")
    rows = unpacked(payments.join(known, "order_id", "left"), "customer_sk")
    return as_contracted("fct_payments", rows, payment_count=F.lit(1))


def fct_reviews(reviews: DataFrame, fct_orders: DataFrame, of_order: Mapping[str, Column] | None = None) -> DataFrame:
    """Dated by the creation of the review, not by the purchase; ``of_order`` are columns made of the keys of the order that go on with it."""
    more = [column.alias(name) for name, column in (of_order or {}).items()]
    known = packed(order_keys(fct_orders).select("order_id", "customer_sk", *more), "customer_sk")
    rows = unpacked(reviews.join(known, "order_id", "left"), "customer_sk")
    return as_contracted("fct_reviews", rows, {"date_sk": "review_creation_date"}, [*(of_order or {})], **A.review_measures())
