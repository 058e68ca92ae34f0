"""Documented business questions and service levels beyond the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions.attributes import category_label
from lakeloom.functions.constants import CRITICAL_NULL_RATE, SEGMENTS, UNKNOWN_KEY
from lakeloom.operators.quality import null_rates
from lakeloom.plans.marts import MONEY_SUM
from lakeloom.plans.metrics import ratio


def daily_rates(quotes: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Quotes with weekend and holiday gaps filled forward to the end of the calendar: one rate per currency and day.

    A row per day turns the as-of lookup of every sale into a plain equality on the day. The
    window runs over the quotes of one currency, one per day.
    """
    following = F.lead("quoted_on").over(Window.partitionBy("currency").orderBy("quoted_on"))
    last = dim_date.agg(F.max("full_date").alias("last")).scalar()
    until = F.coalesce(F.date_sub(following, 1), last)
    spans = quotes.withColumn("_until", until).where("_until >= quoted_on")
    each_day = F.explode(F.sequence("quoted_on", "_until", F.expr("interval 1 day")))
    return spans.select("currency", "rate", each_day.alias("rate_date"))


def sales_in_currency(items: DataFrame, rates: DataFrame, dim_date: DataFrame, currency: str) -> DataFrame:
    """Monthly GMV, converted at the rate of each day of purchase; sales without a rate are counted."""
    return _converted(items, rates, dim_date, currency).groupBy("year_month").agg(*_currency_sums())


def category_margin(items: DataFrame, products: DataFrame, rates: DataFrame, dim_date: DataFrame, currency: str) -> DataFrame:
    """By month and category: GMV and freight, and what is left of it in another currency."""
    named = products.select("product_sk", category_label(F.col("product_category_name_english")).alias("category"))
    rows = _converted(items.join(named, "product_sk", "left"), rates, dim_date, currency)
    freight = F.coalesce("freight_value", F.lit(0).cast("decimal(12,2)"))
    margin = F.sum((F.col("price") - freight).cast("decimal(20,2)") / F.col("rate"))
    return rows.groupBy("year_month", "category").agg(
        *_currency_sums(), F.sum("freight_value").cast(MONEY_SUM).alias("freight"), margin.cast("decimal(38,6)").alias("margin_converted")
    )


def _converted(items: DataFrame, rates: DataFrame, dim_date: DataFrame, currency: str) -> DataFrame:
    days = dim_date.select("date_sk", "full_date", "year_month")
    chosen = rates.where(F.col("currency") == currency).select(F.col("rate_date").alias("full_date"), "rate")
    return items.join(days, "date_sk", "left").join(chosen, "full_date", "left")


def _currency_sums() -> list[Column]:
    converted = F.sum(F.col("price").cast("decimal(20,2)") / F.col("rate"))
    return [
        F.sum("price").cast(MONEY_SUM).alias("gmv"),
        converted.cast("decimal(38,6)").alias("gmv_converted"),
        F.count_if(F.col("rate").isNull()).alias("unconverted"),
    ]


WEATHER_SCHEMA = "region string, daily array<struct<day: date, rain_mm: int>>"


def weather_days(reports: DataFrame, payload: str, severe_mm: int) -> DataFrame:
    """Nested reports flattened to one row per region and day with a flag for severe weather."""
    report = reports.select(F.from_json(payload, WEATHER_SCHEMA).alias("report"))
    flat = report.select("report.region", F.explode("report.daily").alias("entry"))
    return flat.groupBy("region", F.col("entry.day").alias("day")).agg(
        F.max((F.col("entry.rain_mm") >= severe_mm).cast("int")).alias("severe")
    )


def severe_days_so_far(weather: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Running number of severe days per region for every day from the first known to the last.

    Days are those of the reports and of the calendar, which holds every delivery. The window of a
    region holds one row per day.
    """
    ends = weather.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).unionByName(
        dim_date.agg(F.min("full_date").alias("lo"), F.max("full_date").alias("hi"))
    )
    bounds = ends.agg(F.struct(F.date_sub(F.min("lo"), 1).alias("lo"), F.max("hi").alias("hi")).alias("b")).scalar()
    first, last = bounds["lo"], bounds["hi"]
    regions = weather.select("region").distinct()
    each_day = F.explode(F.sequence(first, last, F.expr("interval 1 day")))
    dense = regions.select("region", each_day.alias("day")).join(weather, ["region", "day"], "left")
    running = F.sum(F.coalesce("severe", F.lit(0))).over(Window.partitionBy("region").orderBy("day"))
    return dense.select("region", "day", running.alias("so_far"))


def late_in_severe_weather(deliveries: DataFrame, so_far: DataFrame) -> DataFrame:
    """Late orders per region and how many had a severe day between purchase and delivery.

    Two lookups of the running count replace a join of every order with every day of its window.
    """

    def count_at(name: str, day: str) -> DataFrame:
        return so_far.select("region", F.col("day").alias(day), F.col("so_far").alias(name))

    windows = deliveries.where("is_late = 1").withColumn("day_before", F.date_sub("bought_on", 1))
    counted = windows.join(count_at("until_end", "delivered_on"), ["region", "delivered_on"], "left").join(
        count_at("until_start", "day_before"), ["region", "day_before"], "left"
    )
    # Without both ends there is no window; a region without reports has no severe days.
    dated = F.col("bought_on").isNotNull() & F.col("delivered_on").isNotNull()
    severe = dated & (F.coalesce("until_end", F.lit(0)) > F.coalesce("until_start", F.lit(0)))
    totals = counted.groupBy("region").agg(F.count("*").alias("late"), F.count_if(severe).alias("late_in_severe_weather"))
    return totals.withColumn("share", ratio(F.col("late_in_severe_weather"), F.col("late")))


def segment_moves(history: DataFrame) -> DataFrame:
    """Promotions and demotions per quarter, relative to the sellers there were before it.

    Only quarters with a change of segment or a new seller appear. A seller's window holds one
    row per load, the last one a row per quarter.
    """
    rank = F.array_position(F.array(*[F.lit(s) for s in SEGMENTS]), F.col("seller_segment"))
    members = history.where(F.col("seller_id") != UNKNOWN_KEY)
    quarter_ends = members.groupBy("seller_id", F.date_trunc("quarter", "valid_from").alias("quarter")).agg(
        F.max_by(rank, "valid_from").alias("rank")
    )
    before = F.lag("rank").over(Window.partitionBy("seller_id").orderBy("quarter"))
    moves = quarter_ends.withColumn("before", before)
    per_quarter = moves.groupBy("quarter").agg(
        F.count_if(F.col("rank") > F.col("before")).alias("promoted"),
        F.count_if(F.col("rank") < F.col("before")).alias("demoted"),
        F.count_if(F.col("before").isNull()).alias("joined"),
    )
    earlier = Window.orderBy("quarter").rowsBetween(Window.unboundedPreceding, -1)
    counted = per_quarter.withColumn("sellers_before", F.sum("joined").over(earlier))
    return counted.where("sellers_before is not null").select(
        F.format_string("%d-Q%d", F.year("quarter"), F.quarter("quarter")).alias("year_quarter"),
        "promoted",
        "demoted",
        "sellers_before",
        ratio(F.col("promoted"), F.col("sellers_before")).alias("promotion_rate"),
        ratio(F.col("demoted"), F.col("sellers_before")).alias("demotion_rate"),
    )


def retention_matrix(activity: DataFrame) -> DataFrame:
    """Active customers and value by cohort and months since the first purchase."""
    return activity.groupBy("cohort_year_month", "relative_month").agg(
        F.count_distinct("customer_sk").alias("customers"),
        F.count("*").alias("orders"),
        F.sum("order_value").cast(MONEY_SUM).alias("gmv"),
    )


def volume_gaps(source: DataFrame, target: DataFrame, key: str, day: str) -> DataFrame:
    """Rows per day that the source has and the target lacks. No rows: complete."""
    lost = source.join(target.select(key), key, "left_anti")
    return lost.groupBy(day).agg(F.count("*").alias("lost"))


def freshness(days: DataFrame, loads: DataFrame, deadline_hour: int = 7, target: float = 0.99) -> DataFrame:
    """Per quarter, the days whose data was there by the deadline of the next morning.

    Every day of ``days`` counts; one without a load was not there.
    """
    deadline = F.date_add("day", 1).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(deadline_hour))
    on_time = F.count_if(F.col("loaded_at") <= deadline)
    quarter = F.format_string("%d-Q%d", F.year("day"), F.quarter("day"))
    rate = ratio(on_time, F.count("*"))
    return days.join(loads, "day", "left").groupBy(quarter.alias("year_quarter")).agg(
        F.count("*").alias("days"), on_time.alias("on_time"), rate.alias("rate"), (rate >= target).alias("met")
    )


def critical_nulls(df: DataFrame, columns: list[str], limit: float = CRITICAL_NULL_RATE) -> DataFrame:
    return null_rates(df, columns).withColumn("met", F.col("null_rate") < limit)


def temporal_rules() -> dict[str, Column]:
    """An order is bought, approved, handed over and delivered in that order.

    A moment is held against the latest one known before it, so one that is missing hides nothing.
    """
    steps = [
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
    ]
    known = [F.greatest(*steps[:i], F.lit(None)) for i in range(1, len(steps))]
    return {f"{later}_too_early": F.col(later) < latest for later, latest in zip(steps[1:], known, strict=True)}


def unusual_days(counts: DataFrame, group: str, days: int = 28, deviations: float = 3.0) -> DataFrame:
    """Days whose volume is far from the mean of the days before, per group.

    Sums of whole numbers keep mean and deviation exact. A group has one row per day, ``daily_volume``
    gives days without rows too.
    """
    before = Window.partitionBy(group).orderBy("day").rowsBetween(-days, -1)
    n, total, squares = (
        F.count("volume").over(before),
        F.sum("volume").over(before),
        F.sum(F.col("volume") * F.col("volume")).over(before),
    )
    measured = counts.withColumns({"_n": n, "_total": total, "_squares": squares}).where(F.col("_n") == days)
    mean = F.col("_total").cast("double") / F.col("_n")
    variance = (F.col("_squares") * F.col("_n") - F.col("_total") * F.col("_total")).cast("double") / (
        F.col("_n") * (F.col("_n") - 1)
    )
    scored = measured.select(group, "day", "volume", mean.alias("mean"), F.sqrt(variance).alias("deviation"))
    return scored.where(F.abs(F.col("volume") - F.col("mean")) > F.lit(deviations) * F.col("deviation"))


def daily_volume(df: DataFrame, group: str, moment: str) -> DataFrame:
    """Rows per group and day, 0 for a day without any from the group's first one to the last of all groups."""
    dated = df.where(F.col(moment).isNotNull()).groupBy(group, F.to_date(moment).alias("day")).agg(F.count("*").alias("volume"))
    last = dated.agg(F.max("day").alias("last")).scalar()
    each_day = F.explode(F.sequence("first", last, F.expr("interval 1 day"))).alias("day")
    spans = dated.groupBy(group).agg(F.min("day").alias("first")).select(group, each_day)
    return spans.join(dated, [group, "day"], "left").select(group, "day", F.coalesce("volume", F.lit(0)).alias("volume"))
