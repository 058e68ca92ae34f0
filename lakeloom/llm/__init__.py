"""Operators of a training-data pipeline, with their queries. Nothing else in the library imports this."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeloom.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    """Register a function of (spark, folder of the given tables), with its SQL text if there is one."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = lambda spark, folder: build(prepare(spark), folder)
        if oracle is not None:
            ORACLES[key] = oracle
        return build

    return register


def load_all() -> None:
    """Import the module that registers the queries."""
    from lakeloom.llm import queries  # noqa: F401
