"""Sessions and purchase funnel of a clickstream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions.constants import SESSION_GAP_MINUTES

FUNNEL = ("view", "cart", "checkout", "payment")


def first_reach(steps: Sequence[str] = FUNNEL) -> list[Column]:
    """First moment of each step."""
    return [F.min(F.when(F.col("step") == step, F.col("ts"))).alias(f"first_{step}") for step in steps]


def reached_in_order(steps: Sequence[str] = FUNNEL) -> list[Column]:
    """1 where a step and all before it were first reached in funnel order."""
    flags, so_far = [], None
    for before, step in zip([None, *steps], steps):
        moment = F.col(f"first_{step}")
        here = moment.isNotNull() if before is None else moment >= F.col(f"first_{before}")
        so_far = here if so_far is None else so_far & here
        flags.append(F.coalesce(so_far, F.lit(False)).cast("int").alias(f"reached_{step}"))
    return flags


def sessions(clicks: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES) -> DataFrame:
    """One row per session: a pause longer than the gap ends it.

    Two events in the same slot as long as the gap always share a session, so events are first
    summed up per user and slot, with partial aggregation. What is left of a user to be put in
    order is at most one row per slot of the period, however many events the user has.
    """
    gap = gap_minutes * 60_000_000
    micros = F.unix_micros("ts")
    slots = clicks.groupBy("user_id", (micros - F.pmod(micros, F.lit(gap))).alias("slot")).agg(
        F.min("ts").alias("started"), F.max("ts").alias("ended"), F.count("*").alias("events"), *first_reach()
    )
    in_order = Window.partitionBy("user_id").orderBy("slot")
    pause = F.unix_micros("started") - F.unix_micros(F.lag("ended").over(in_order))
    numbered = slots.withColumn("opens", F.when(pause > gap, 1).otherwise(0)).withColumn(
        "session", F.sum("opens").over(in_order)
    )
    return (
        numbered.groupBy("user_id", "session")
        .agg(
            F.min("started").alias("session_start"),
            F.max("ended").alias("session_end"),
            F.sum("events").alias("events"),
            *[F.min(f"first_{step}").alias(f"first_{step}") for step in FUNNEL],
        )
        .drop("session")
    )


def funnel(found: DataFrame) -> DataFrame:
    """Sessions per step and the conversion from the step before."""
    flagged = found.select(*reached_in_order())
    totals = flagged.agg(F.count("*").alias("sessions"), *[F.sum(f"reached_{s}").alias(s) for s in FUNNEL])
    before = ["sessions", *FUNNEL]
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(s).alias("step"), F.col(s).alias("reached"), F.col(b).alias("before"))
        for i, (b, s) in enumerate(zip(before, FUNNEL), start=1)
    ]
    return totals.select(F.explode(F.array(*rows)).alias("row")).select(
        "row.position", "row.step", "row.reached", F.try_divide("row.reached", "row.before").alias("conversion")
    )


def abandoned(found: DataFrame) -> DataFrame:
    """Sessions with a cart and no payment: whom a recovery mail would go to."""
    return found.where("first_cart is not null and first_payment is null")


def abandonment_rate(found: DataFrame) -> DataFrame:
    carts = found.where("first_cart is not null")
    return carts.agg(
        F.count("*").alias("carts"),
        F.count_if(F.col("first_payment").isNull()).alias("abandoned"),
    ).select("*", F.try_divide("abandoned", "carts").alias("abandonment_rate"))
