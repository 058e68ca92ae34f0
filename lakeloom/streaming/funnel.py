"""Purchase funnel over a click stream, each session out as soon as it is certain to be over."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakeloom.functions.constants import SESSION_GAP_MINUTES
from lakeloom.operators.sessions import FUNNEL, first_reach

# How long a cart waits for its payment before the customer is written to.
PATIENCE_MINUTES = 30


def read_clicks(spark: SparkSession, folder: str, name: str, schema: StructType) -> DataFrame:
    """Files of a folder as a stream."""
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)


def closed_sessions(clicks: DataFrame, delay_minutes: int = 3, gap_minutes: int = SESSION_GAP_MINUTES) -> DataFrame:
    """Finished sessions of a stream with ``user_id``, ``ts`` and ``step``.

    A session is emitted once the watermark has passed its last event by the gap, so a click may
    come up to ``delay_minutes`` late and state is kept for open sessions only.
    """
    window = F.session_window("ts", f"{gap_minutes} minutes")
    return (
        clicks.withWatermark("ts", f"{delay_minutes} minutes")
        .groupBy("user_id", window.alias("session"))
        .agg(F.max("ts").alias("session_end"), F.count("*").alias("events"), *first_reach())
        .select(
            "user_id",
            F.col("session.start").alias("session_start"),
            "session_end",
            "events",
            *[f"first_{step}" for step in FUNNEL],
        )
    )


def recovery_triggers(clicks: DataFrame, delay_minutes: int = 3, patience_minutes: int = PATIENCE_MINUTES) -> DataFrame:
    """Carts without a payment of the same user within ``patience_minutes``, each out as soon as that is certain.

    Carts and payments are two streams joined on the user and an interval, so a cart waits in state for its payment and
    comes out alone when the watermark reaches its end: ``delay_minutes`` after it is due, whatever else the user
    clicks meanwhile. Payments are kept no longer than a cart may wait. Every cart click counts for itself.
    """
    timed = clicks.withWatermark("ts", f"{delay_minutes} minutes")
    # A condition on the step alone would be pushed below the watermark, which then stood still without payments.
    moments = {step: F.when(F.col("step") == step, F.col("ts")) for step in ("cart", "payment")}
    carts = timed.where(moments["cart"].isNotNull()).select("user_id", F.col("ts").alias("cart_at"))
    payments = timed.where(moments["payment"].isNotNull()).select(F.col("user_id").alias("payer"), F.col("ts").alias("paid_at"))
    due = F.col("cart_at") + F.expr(f"interval {patience_minutes} minutes")
    paid = (F.col("user_id") == F.col("payer")) & (F.col("paid_at") >= F.col("cart_at")) & (F.col("paid_at") < due)
    waited = carts.join(payments, paid, "leftOuter")
    return waited.where("payer is null").select("user_id", "cart_at", due.alias("due_at"))


def run_available(stream: DataFrame, target: str) -> DataFrame:
    """Process what there is, append it to ``target`` exactly once, and read the target.

    The checkpoint below the target makes a restart go on where the last run stopped.
    """
    running = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", f"{target}/data")
        .option("checkpointLocation", f"{target}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{target}/data")


def step_counts(clicks: DataFrame, delay_minutes: int = 3, window_minutes: int = 5) -> DataFrame:
    """Clicks of each step per short window of event time, for update mode.

    A count goes out with the first trigger that has a click of its window and again whenever it grows,
    so what is seen is no older than one trigger; the watermark only bounds the state.
    """
    window = F.window("ts", f"{window_minutes} minutes")
    return (
        clicks.withWatermark("ts", f"{delay_minutes} minutes")
        .groupBy(window.alias("w"), "step")
        .agg(F.count("*").alias("clicks"))
        .select(F.col("w.start").alias("window_start"), "step", "clicks")
    )


def start_updates(counts: DataFrame, target: str, **trigger) -> StreamingQuery:
    """Append what each trigger changed to ``target``, one folder a batch, so a repeated batch replaces its own."""

    def append(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/data/batch={number}")

    writer = counts.writeStream.outputMode("update").foreachBatch(append)
    return writer.option("checkpointLocation", f"{target}/checkpoint").trigger(**trigger).start()


def latest_counts(spark: SparkSession, target: str) -> DataFrame:
    """The last count of each window and step; counts only grow."""
    seen = spark.read.parquet(f"{target}/data")
    return seen.groupBy("window_start", "step").agg(F.max("clicks").alias("clicks"))
