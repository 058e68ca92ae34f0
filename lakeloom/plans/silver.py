"""Silver: typed, cleaned, one row per business key.

``ENTITIES`` declares what each entity holds and how each column is cleaned; ``shaped`` builds any of
them. What needs a second extract, or a choice among rows, is a step of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.cleaning import (
    blank_to_null,
    clean_code,
    clean_text,
    to_double,
    to_int,
    to_money,
    to_timestamp,
)
from lakeloom.operators.grouping import latest_per_key, median_per_key, mode_per_key, one_per_key

Cleaning = Callable[[str], Column]


@dataclass(frozen=True)
class Entity:
    """Columns in order with their cleaning, and what the extract does differently."""

    columns: Mapping[str, Cleaning]
    renamed: Mapping[str, str] = field(default_factory=dict)  # where the source spells a column otherwise
    repeated_by: Sequence[str] = ()  # the key of rows that the extract may repeat


def _all(cleaning: Cleaning, *names: str) -> dict[str, Cleaning]:
    return dict.fromkeys(names, cleaning)


ORDER_MOMENTS = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]

ENTITIES = {
    "customers": Entity(
        _all(F.col, "customer_id", "customer_unique_id", "customer_zip_code_prefix")
        | {"customer_city": clean_text, "customer_state": clean_code}
    ),
    "identity": Entity(_all(F.col, "customer_id", "customer_unique_id"), repeated_by=("customer_id",)),
    "sellers": Entity(
        _all(F.col, "seller_id", "seller_zip_code_prefix") | {"seller_city": clean_text, "seller_state": clean_code}
    ),
    "categories": Entity(
        _all(clean_text, "product_category_name", "product_category_name_english"), repeated_by=("product_category_name",)
    ),
    "products": Entity(
        {"product_id": F.col, "product_category_name": clean_text}
        | _all(to_int, "product_name_length", "product_description_length", "product_photos_qty")
        | _all(to_int, "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"),
        # Spelt so at the source.
        renamed={"product_name_length": "product_name_lenght", "product_description_length": "product_description_lenght"},
    ),
    "geolocation": Entity(
        {"zip_code_prefix": F.col, "lat": to_double, "lng": to_double, "city": clean_text, "state": clean_code},
        renamed={
            "zip_code_prefix": "geolocation_zip_code_prefix",
            "lat": "geolocation_lat",
            "lng": "geolocation_lng",
            "city": "geolocation_city",
            "state": "geolocation_state",
        },
    ),
    "orders": Entity(
        _all(F.col, "order_id", "customer_id") | {"order_status": clean_code} | _all(to_timestamp, *ORDER_MOMENTS)
    ),
    "order_items": Entity(
        {"order_id": F.col, "order_item_id": to_int, "product_id": F.col, "seller_id": F.col}
        | {"shipping_limit_date": to_timestamp}
        | _all(to_money, "price", "freight_value")
    ),
    "payments": Entity(
        {"order_id": F.col, "payment_sequential": to_int, "payment_type": clean_text}
        | {"payment_installments": to_int, "payment_value": to_money}
    ),
    # A comment is kept letter by letter.
    "reviews": Entity(
        {"review_id": F.col, "order_id": F.col, "review_score": to_int}
        | _all(blank_to_null, "review_comment_title", "review_comment_message")
        | _all(to_timestamp, "review_creation_date", "review_answer_timestamp"),
        repeated_by=("review_id", "order_id"),
    ),
}

PRIMARY_KEYS = {
    "customers": ["customer_unique_id"],
    "sellers": ["seller_id"],
    "products": ["product_id"],
    "geolocation": ["zip_code_prefix"],
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "payments": ["order_id", "payment_sequential"],
    "reviews": ["review_id", "order_id"],
}


def shaped(name: str, raw: DataFrame) -> DataFrame:
    """The entity as declared, from its extract alone."""
    entity = ENTITIES[name]
    rows = raw.select(*[clean(entity.renamed.get(c, c)).alias(c) for c, clean in entity.columns.items()])
    return one_per_key(rows, list(entity.repeated_by)) if entity.repeated_by else rows


def looked_up(rows: DataFrame, bridge: DataFrame, key: str) -> DataFrame:
    """Left join on ``key``; what is looked up stands right behind it."""
    found = [c for c in bridge.columns if c != key]
    order = [x for c in rows.columns for x in ((c, *found) if c == key else (c,))]
    return rows.join(bridge, key, "left").select(*order)


def customers(raw_customers: DataFrame, raw_orders: DataFrame) -> DataFrame:
    """One row per person, located where the most recent order says."""
    bought = raw_orders.select("customer_id", to_timestamp("order_purchase_timestamp").alias("purchased_at"))
    places = [c for c in ENTITIES["customers"].columns if c not in ("customer_id", "customer_unique_id")]
    seen = looked_up(shaped("customers", raw_customers), bought, "customer_id")
    return latest_per_key(seen, PRIMARY_KEYS["customers"], ["purchased_at", "customer_id"], places)


def sellers(raw: DataFrame) -> DataFrame:
    return shaped("sellers", raw)


def category_catalogue(raw: DataFrame) -> DataFrame:
    return shaped("categories", raw)


def products(raw: DataFrame, raw_categories: DataFrame) -> DataFrame:
    """Products with their translated category; an untranslated one stays."""
    return looked_up(shaped("products", raw), category_catalogue(raw_categories), "product_category_name")


def geolocation_points(raw: DataFrame) -> DataFrame:
    return shaped("geolocation", raw)


def geolocation(raw: DataFrame) -> DataFrame:
    """One place per zip: median coordinates, most frequent city and state."""
    points, key = geolocation_points(raw), PRIMARY_KEYS["geolocation"]
    place = median_per_key(points, key, latitude=F.col("lat"), longitude=F.col("lng"))
    return place.join(mode_per_key(points, key, ["city", "state"]), key, "left")


def identity(raw_customers: DataFrame) -> DataFrame:
    """Bridge from the per-order customer id to the person."""
    return shaped("identity", raw_customers)


def orders(raw: DataFrame, raw_customers: DataFrame) -> DataFrame:
    return looked_up(shaped("orders", raw), identity(raw_customers), "customer_id")


def order_items(raw: DataFrame) -> DataFrame:
    return shaped("order_items", raw)


def payments(raw: DataFrame) -> DataFrame:
    return shaped("payments", raw)


def reviews(raw: DataFrame) -> DataFrame:
    return shaped("reviews", raw)
