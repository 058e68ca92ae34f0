"""Business marts over the star schema, with column names and labels consumers already use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions import attributes as A
from lakeloom.functions.constants import REPURCHASE_WINDOWS, UNKNOWN_DATE_KEY, UNKNOWN_KEY
from lakeloom.operators.dimension import join_on_digest

MONEY_SUM = "decimal(38,2)"

PRIMARY_KEYS = {
    "mart_cohortes": ["cohort_year_month"],
    "mart_satisfaccion": ["year_month", "tramo_retraso"],
    "mart_ventas_categoria": ["year_month", "product_category"],
    "mart_segmento_vendedor": ["year_month", "seller_segment"],
}


def _total(value: Column) -> Column:
    return F.sum(value).cast(MONEY_SUM)


def known_days(dim_date: DataFrame, *columns: str) -> DataFrame:
    """Calendar without the unknown member, which belongs to no month."""
    return dim_date.where(F.col("date_sk") != UNKNOWN_DATE_KEY).select("date_sk", *columns)


def order_activity(fct_orders: DataFrame, dim_customer: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Every order of a known customer with its month relative to the cohort."""
    people = dim_customer.where(F.col("customer_sk") != UNKNOWN_KEY).select(
        "customer_sk", "cohort_year_month", "first_purchase_date"
    )
    bought = known_days(dim_date, "full_date").withColumnRenamed("date_sk", "purchase_date_sk")
    return (
        fct_orders.select("customer_sk", "purchase_date_sk", "order_value")
        .join(bought, "purchase_date_sk")
        .join(people, "customer_sk")
        .select(
            "cohort_year_month",
            "customer_sk",
            "order_value",
            A.months_since(F.col("first_purchase_date"), F.col("full_date")).alias("relative_month"),
        )
    )


def cohorts(activity: DataFrame) -> DataFrame:
    """Cohort size, repurchases within each window and accumulated value.

    Customers are reduced to one row of flags first, so the distinct counts become plain sums:
    no row is multiplied per distinct aggregate and one shuffle on the customer is enough.
    """
    month = F.col("relative_month")
    per_customer = activity.groupBy("cohort_year_month", "customer_sk").agg(
        *[F.max(month.between(1, n).cast("int")).alias(f"within_{n}") for n in REPURCHASE_WINDOWS],
        F.sum("order_value").alias("spent"),
        F.sum(F.when(month == 0, F.col("order_value"))).alias("spent_first"),
    )
    return per_customer.groupBy("cohort_year_month").agg(
        F.count("*").alias("clientes_cohorte"),
        *[F.sum(f"within_{n}").alias(f"recompra_{n}m") for n in REPURCHASE_WINDOWS],
        _total(F.col("spent")).alias("gmv_acumulado"),
        _total(F.col("spent_first")).alias("gmv_primera_compra"),
    )


def mart_cohortes(fct_orders: DataFrame, dim_customer: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Retention and value by month of first purchase."""
    return cohorts(order_activity(fct_orders, dim_customer, dim_date)).orderBy("cohort_year_month")


def mart_satisfaccion(fct_orders: DataFrame, fct_reviews: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Review scores by purchase month and delay; delivered orders only."""
    delivered = fct_orders.where("is_delivered = 1").select("order_id", "purchase_date_sk", "is_late", "days_late")
    months = known_days(dim_date, "year_month").withColumnRenamed("date_sk", "purchase_date_sk")
    return (
        delivered.join(months, "purchase_date_sk")
        .join(fct_reviews, "order_id")
        .groupBy("year_month", A.delay_bucket(F.col("is_late"), F.col("days_late")).alias("tramo_retraso"))
        .agg(
            F.sum("review_count").alias("reviews"),
            F.sum("is_negative").alias("reviews_negativas"),
            F.sum("is_positive").alias("reviews_positivas"),
            A.exact_avg(F.col("review_score")).alias("score_medio"),
            A.exact_avg(F.col("response_time_hours")).alias("tiempo_respuesta_medio_h"),
            A.exact_avg(F.col("days_late")).alias("retraso_medio_dias"),
        )
    )


def mart_ventas_categoria(fct_order_items: DataFrame, dim_product: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Sales and contribution margin by purchase month and category."""
    categories = dim_product.select(
        "product_sk", A.category_label(F.col("product_category_name_english")).alias("product_category")
    )
    price, freight = F.col("price"), F.col("freight_value")
    return (
        join_on_digest(fct_order_items, categories, "product_sk")
        .join(known_days(dim_date, "year_month", "year"), "date_sk")
        .groupBy("year_month", "year", "product_category")
        .agg(
            _total(price).alias("gmv"),
            _total(freight).alias("ingreso_flete"),
            _total(F.col("gross_revenue")).alias("ingreso_bruto"),
            (F.sum(price) - F.sum(freight)).cast(MONEY_SUM).alias("margen_contribucion"),
            F.sum("item_count").alias("items_vendidos"),
            F.count_distinct("order_id").alias("ordenes"),
        )
    )


def mart_segmento_vendedor(fct_order_items: DataFrame, dim_seller: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Sales by purchase month and the segment the seller had then."""
    return (
        fct_order_items.join(known_days(dim_date, "year_month"), "date_sk")
        .join(dim_seller.select("seller_sk", "seller_segment"), "seller_sk")
        .groupBy("year_month", "seller_segment")
        .agg(
            _total(F.col("price")).alias("gmv"),
            F.count("order_item_id").alias("items_vendidos"),
            F.count_distinct("order_id").alias("ordenes"),
        )
    )
