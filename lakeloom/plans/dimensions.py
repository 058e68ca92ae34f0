"""Gold dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions import attributes as A
from lakeloom.functions import constants as K
from lakeloom.functions.keys import date_key, surrogate_key
from lakeloom.operators.dimension import with_unknown_member
from lakeloom.operators.history import HistorySpec

SELLER_HISTORY = HistorySpec(
    natural="seller_id",
    surrogate="seller_sk",
    tracked=["seller_zip_code_prefix", "seller_city", "seller_state", "seller_segment"],
    carried=["gmv_window"],
)

PRIMARY_KEYS = {
    "dim_date": ["date_sk"],
    "dim_customer": ["customer_sk"],
    "dim_product": ["product_sk"],
    "dim_geography": ["geography_sk"],
    "dim_seller": ["seller_sk"],
}


# Moments of an order that facts hold as date keys.
KEYED_MOMENTS = ("order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date")


def days(bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    """One row per day from ``first`` to ``last``, both included."""
    return bounds.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("full_date"))


def _calendar(all_days: DataFrame) -> DataFrame:
    described = all_days.select("full_date", date_key("full_date").alias("date_sk"), *A.calendar_attributes("full_date"))
    return with_unknown_member(described, "date_sk")


def dim_date(orders: DataFrame, reviews: DataFrame, at_least: tuple[date, date]) -> DataFrame:
    """Calendar of a given range and of the whole years of every moment that becomes a date key.

    So a fact finds its day whatever the given range; both ends come from one row an extract.
    """
    moments = [c for c in orders.columns if c in KEYED_MOMENTS]
    ends = [
        df.agg(F.least(*[F.min(c) for c in columns], F.lit(None)).alias("lo"), F.greatest(*[F.max(c) for c in columns], F.lit(None)).alias("hi"))
        for df, columns in ((orders, moments), (reviews, ["review_creation_date"]))
    ]
    both = ends[0].unionByName(ends[1]).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    first = F.least(F.lit(at_least[0]), F.make_date(F.year("lo"), F.lit(1), F.lit(1)))
    last = F.greatest(F.lit(at_least[1]), F.make_date(F.year("hi"), F.lit(12), F.lit(31)))
    return _calendar(days(both, first, last))


def first_purchases(orders: DataFrame) -> DataFrame:
    """First purchase per person, whatever became of the order."""
    first = orders.groupBy("customer_unique_id").agg(F.min("order_purchase_timestamp").alias("first_purchase_date"))
    return first.withColumn("cohort_year_month", A.month_label(F.col("first_purchase_date")))


def dim_customer(customers: DataFrame, orders: DataFrame) -> DataFrame:
    known = customers.join(first_purchases(orders), "customer_unique_id", "left")
    return with_unknown_member(known.withColumn("customer_sk", surrogate_key("customer_unique_id")), "customer_sk")


def dim_product(products: DataFrame) -> DataFrame:
    sides = [F.col(f"product_{side}_cm") for side in ("length", "height", "width")]
    described = products.select(
        "*",
        A.volume_cm3(*sides).alias("product_volume_cm3"),
        A.weight_bucket(F.col("product_weight_g")).alias("weight_bucket"),
        surrogate_key("product_id").alias("product_sk"),
    )
    return with_unknown_member(described, "product_sk")


def dim_geography(geolocation: DataFrame) -> DataFrame:
    located = geolocation.select(
        surrogate_key("zip_code_prefix").alias("geography_sk"),
        "zip_code_prefix",
        "city",
        "state",
        A.region_of(F.col("state")).alias("region"),
        "latitude",
        "longitude",
    )
    return with_unknown_member(located, "geography_sk")


def in_trailing_window(moment: str, as_of: date, window_days: int = K.SEGMENT_WINDOW_DAYS) -> Column:
    """Dates stand for their midnight, so sales later on ``as_of`` itself are not in the window."""
    return F.col(moment).between(F.lit(as_of - timedelta(days=window_days)), F.lit(as_of))


def seller_snapshots(
    sellers: DataFrame,
    items: DataFrame,
    orders: DataFrame,
    dates: Sequence[date],
    silver_from: float = K.SILVER_FROM,
    gold_above: float = K.GOLD_ABOVE,
    window_days: int = K.SEGMENT_WINDOW_DAYS,
) -> DataFrame:
    """State and segment of every seller at each date, unknown seller included.

    All dates come out of one pass over the sales: one conditional sum per date.
    """
    names = [f"gmv_{d:%Y%m%d}" for d in dates]
    sums = [
        F.sum(F.when(in_trailing_window("order_purchase_timestamp", d, window_days), F.col("price"))).alias(name)
        for d, name in zip(dates, names)
    ]
    reach = F.col("order_purchase_timestamp").between(
        F.lit(min(dates) - timedelta(days=window_days)), F.lit(max(dates))
    )
    bought = orders.where(reach).select("order_id", "order_purchase_timestamp")
    sales = items.select("order_id", "seller_id", "price").join(bought, "order_id").groupBy("seller_id").agg(*sums)
    unknown = sellers.sparkSession.range(1).select(
        F.lit(K.UNKNOWN_KEY).alias("seller_id"),
        *[F.lit(K.UNKNOWN_LABEL).alias(c) for c in SELLER_HISTORY.tracked if c != "seller_segment"],
    )
    dated = [F.struct(F.lit(d).alias("as_of"), F.col(name).alias("gmv")) for d, name in zip(dates, names)]
    stacked = (
        unknown.unionByName(sellers)
        .join(sales, "seller_id", "left")
        .withColumn("_dated", F.explode(F.array(*dated)))
        .select("*", "_dated.as_of", F.coalesce("_dated.gmv", F.lit(0).cast("decimal(12,2)")).alias("gmv_window"))
    )
    segment = A.segment_of(F.col("gmv_window"), silver_from, gold_above)
    return stacked.select(
        "as_of",
        "seller_id",
        "seller_zip_code_prefix",
        "seller_city",
        "seller_state",
        F.when(F.col("seller_id") == K.UNKNOWN_KEY, K.UNKNOWN_LABEL).otherwise(segment).alias("seller_segment"),
        "gmv_window",
    )


def seller_snapshot(sellers: DataFrame, items: DataFrame, orders: DataFrame, as_of: date, **rules) -> DataFrame:
    """State and segment of every seller at one date."""
    return seller_snapshots(sellers, items, orders, [as_of], **rules).drop("as_of")
