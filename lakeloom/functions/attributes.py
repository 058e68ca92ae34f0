"""Business attributes and flags derived row by row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeloom.functions import constants as K


def calendar_attributes(day: str) -> list[Column]:
    """The descriptive columns of one calendar day. Sunday is day 1 of the week."""
    d = F.col(day)
    return [
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        month_label(d).alias("year_month"),
        F.format_string("%d-Q%d", F.year(d), F.quarter(d)).alias("year_quarter"),
    ]


def month_label(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM")


def region_of(state: Column, states_by_region: Mapping[str, Sequence[str]] = K.STATES_BY_REGION) -> Column:
    """Macro region of a state code; NULL for a code the table does not know."""
    pairs = [(code, region) for region, codes in states_by_region.items() for code in codes]
    lookup = F.create_map(*[F.lit(v) for v in chain.from_iterable(pairs)])
    return F.element_at(lookup, state)


def bucket(value: Column, limits: Sequence[float], labels: Sequence[str]) -> Column:
    """Below the first limit, up to the second, beyond it; NULL for NULL."""
    (low, high), (under, inside, beyond) = limits, labels
    return F.when(value < low, under).when(value <= high, inside).when(value > high, beyond)


def weight_bucket(grams: Column) -> Column:
    return bucket(grams, K.WEIGHT_LIMITS, K.WEIGHT_LABELS)


def volume_cm3(*sides: Column) -> Column:
    """Product of the sides in 64 bits: three ints can overflow 32."""
    volume = F.lit(1).cast("bigint")
    for side in sides:
        volume = volume * side
    return volume


def segment_of(gmv: Column, silver_from: float = K.SILVER_FROM, gold_above: float = K.GOLD_ABOVE) -> Column:
    return F.coalesce(bucket(gmv, (silver_from, gold_above), K.SEGMENTS), F.lit(K.SEGMENTS[0]))


def is_delivered(status: Column) -> Column:
    return (status == K.DELIVERED).cast("int")


def is_late(delivered: Column, estimated: Column) -> Column:
    """Full timestamps decide; an order without a delivery time is not late."""
    return F.coalesce((delivered > estimated).cast("int"), F.lit(0))


def is_negative(score: Column) -> Column:
    return (score <= K.NEGATIVE_SCORE_MAX).cast("int")


def is_positive(score: Column) -> Column:
    return (score >= K.POSITIVE_SCORE_MIN).cast("int")


def order_measures() -> dict[str, Column]:
    """Measures of an order, from its moments and the totals of its items."""
    bought, delivered, promised = (
        F.col(f"order_{c}") for c in ("purchase_timestamp", "delivered_customer_date", "estimated_delivery_date")
    )
    return {
        "days_to_delivery": F.datediff(delivered, bought),
        "days_late": F.datediff(delivered, promised),
        "is_delivered": is_delivered(F.col("order_status")),
        "is_late": is_late(delivered, promised),
        "order_item_count": F.coalesce("order_item_count", F.lit(0)),
        "order_value": F.coalesce("order_value", F.lit(0).cast("decimal(12,2)")),
        "order_count": F.lit(1),
    }


def review_measures() -> dict[str, Column]:
    score, asked, answered = (F.col(f"review_{c}") for c in ("score", "creation_date", "answer_timestamp"))
    return {
        "is_negative": is_negative(score),
        "is_positive": is_positive(score),
        "response_time_hours": hours_between(asked, answered),
        "review_count": F.lit(1),
    }


def hours_between(start: Column, end: Column) -> Column:
    return ((F.unix_timestamp(end) - F.unix_timestamp(start)) / 3600).cast("decimal(10,2)")


def delay_bucket(late: Column, days: Column) -> Column:
    first, second = K.DELAY_LIMITS
    return F.when(late == 0, K.DELAY_ON_TIME).otherwise(bucket(days, (first + 1, second), K.DELAY_LABELS))


def category_label(category: Column) -> Column:
    return F.coalesce(category, F.lit(K.NO_CATEGORY))


def months_since(start: Column, moment: Column) -> Column:
    """Calendar months, not thirty-day spans: 31 January to 1 February is one."""
    return (F.year(moment) - F.year(start)) * 12 + F.month(moment) - F.month(start)


def exact_avg(value: Column) -> Column:
    """Mean with one rounding only, so it does not depend on the order of the rows."""
    return F.sum(value).cast("double") / F.count(value)
