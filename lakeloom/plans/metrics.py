"""Canonical metrics. Ratios are never stored: both parts are summed, then divided."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.attributes import exact_avg
from lakeloom.functions.constants import REPURCHASE_WINDOWS
from lakeloom.plans.marts import MONEY_SUM


def ratio(part: Column, whole: Column) -> Column:
    """NULL where there is nothing to divide by."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def revenue(items: DataFrame, by: Sequence[str]) -> DataFrame:
    """GMV, freight and gross revenue."""
    sums = {"gmv": "price", "freight_revenue": "freight_value", "gross_revenue": "gross_revenue"}
    return items.groupBy(*by).agg(*[F.sum(c).cast(MONEY_SUM).alias(name) for name, c in sums.items()])


def average_ticket(orders: DataFrame, by: Sequence[str]) -> DataFrame:
    # An order is one row, so its count is a sum that is added up before the shuffle.
    value, count = F.sum("order_value"), F.sum("order_count")
    return orders.groupBy(*by).agg(count.alias("orders"), ratio(value, count).alias("average_ticket"))


def late_share(orders: DataFrame, by: Sequence[str]) -> DataFrame:
    """Late among delivered orders, and the mean delay of the late ones alone."""
    late, delivered = F.sum("is_late"), F.sum("is_delivered")
    delay = exact_avg(F.when(F.col("is_late") == 1, F.col("days_late")))
    return orders.groupBy(*by).agg(
        late.alias("late"),
        delivered.alias("delivered"),
        ratio(late, delivered).alias("late_share"),
        delay.alias("mean_delay"),
    )


def review_scores(reviews: DataFrame, by: Sequence[str]) -> DataFrame:
    negative, count = F.sum("is_negative"), F.sum("review_count")
    return reviews.groupBy(*by).agg(
        exact_avg(F.col("review_score")).alias("mean_score"), ratio(negative, count).alias("negative_share")
    )


def repurchase_rates(cohorts: DataFrame) -> DataFrame:
    size = F.col("clientes_cohorte")
    rates = [ratio(F.col(f"recompra_{n}m"), size).alias(f"rate_{n}m") for n in (3, 6, 12)]
    return cohorts.select("cohort_year_month", *rates)


def lifetime_value(cohorts: DataFrame) -> DataFrame:
    """Accumulated value per customer of the cohort."""
    value = ratio(F.col("gmv_acumulado"), F.col("clientes_cohorte"))
    return cohorts.select("cohort_year_month", value.alias("ltv"))


def lifetime_windows(activity: DataFrame, months: Sequence[int] = REPURCHASE_WINDOWS) -> DataFrame:
    """Value per customer of a cohort within so many months of the first purchase.

    Customers are summed up first, so none is counted twice and a busy one is one row a task.
    """
    spent = {n: F.sum(F.when(F.col("relative_month") <= n, F.col("order_value"))).alias(f"within_{n}") for n in months}
    per_customer = activity.groupBy("cohort_year_month", "customer_sk").agg(*spent.values())
    size = F.count("*")
    value = [ratio(F.coalesce(F.sum(f"within_{n}"), F.lit(0)), size).alias(f"ltv_{n}m") for n in months]
    return per_customer.groupBy("cohort_year_month").agg(size.alias("customers"), *value)


def segment_gmv(segments: DataFrame) -> DataFrame:
    """GMV of each segment as valid at purchase."""
    return segments.groupBy("seller_segment").agg(F.sum("gmv").cast(MONEY_SUM).alias("gmv"))
