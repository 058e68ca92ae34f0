"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Result = TypeVar("Result")

# Only run-time SQL settings, so they can be applied to a session someone else started.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Fact-to-dimension joins rely on this to split a hot key over many tasks; the force
    # flag keeps the split even where it costs the next operator one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Sessions of a busy user are merged in each map task before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Open windows live on the executors' disks with changelogs in the checkpoint, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# Shuffle files of a finished write are of no use; by default they stay until the driver happens to collect garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# What a task of a write reads, unless the session says otherwise: splits and merged shuffle partitions of bounded size, so that
# tables grow by tasks and not by what one task sorts or keeps in memory. Adaptive execution merges the partitions of small tables.
INITIAL_PARTITIONS = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", 256)
TASK_SIZES = {"spark.sql.files.maxPartitionBytes": "32m", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}

_LOCAL: list[str] = []


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings every job of this package assumes."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_spark(app_name: str = "lakeloom", master: str | None = None, **settings: str) -> SparkSession:
    """Start a session. Without ``master`` the one of spark-submit is used."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session that names none gets a folder of its own, one for each process; on a cluster a
    machine-local folder would be lost with its executor, so the job refuses to start. The checkpoint
    directory of the session is left as it is.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="lakeloom-"))
    return _LOCAL[0]


@contextmanager
def _held(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """The settings hold inside and are as before behind."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes and counts inside delete their shuffle files as they end, and their tasks are of bounded size.

    Not for a result that is looked at more than once: the second look would find its shuffles gone.
    """
    key, least = INITIAL_PARTITIONS
    partitions = max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = {key: str(partitions)} | TASK_SIZES
    bounds = {key: value for key, value in bounds.items() if spark.conf.get(key, None) is None}
    with _held(spark, {SHUFFLE_CLEANUP: "true"} | bounds):
        yield


def at_once(spark: SparkSession, *steps: Callable[[], Result]) -> list[Result]:
    """What the steps return, which do not depend on each other and run at the same time, so that none waits for the last tasks of another.

    Their writes are short, as settings belong to the session. The first failure is raised once all steps have ended.
    """
    with short_shuffles(spark), ThreadPoolExecutor(len(steps)) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [future.result() for future in futures]


def working_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to a folder of their own and read again, so that Catalyst knows their size."""
    folder = working_folder(df.sparkSession, purpose)
    with short_shuffles(df.sparkSession):
        df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
