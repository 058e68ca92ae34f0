"""Registered queries, each with the SQL text that states the same result independently."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeloom.plans.star import GIVEN_TABLES, Star
from lakeloom.registry.oracle import with_inputs
from lakeloom.session import prepare
from lakeloom.sources.standins import Extracts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    """Register a function of a ``Star`` under a key, with its SQL counterpart if there is one."""

    def register(build: Callable[[Star], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Star(Extracts(prepare(spark), folder), GIVEN_TABLES))

        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = with_inputs(oracle)
        return build

    return register


def load_all() -> None:
    """Import every module that registers queries."""
    from lakeloom.registry import (  # noqa: F401
        aggregates,
        columns,
        control,
        entities,
        filters_joins,
        metrics,
        quality,
        requirements,
        storage,
        stored,
    )
