"""Every registered query against its SQL counterpart, and properties all plans share."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from lakeloom import registry
from lakeloom.registry.oracle import with_inputs
from tests.compare import connect, differences, spark_result, type_differences
from tests.conftest import plan_text

registry.load_all()
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES

# No answer is the right answer: these look for faults in clean tables.
EMPTY_WHEN_CLEAN = {
    "D1_unique", "D2_not_null", "D3_accepted_values", "D4_relationships", "D5_singular", "F7_violation_predicate",
    "S8_model_reference", "X10_volume", "X15_history_integrity", "X15_one_current_per_seller",
}
# No product of rows with rows, no rows through Python.
NEVER = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "InPandas")
# Windows over groups bounded by loads, dates, quotes or time slots; nothing else has a window.
WINDOWED = {
    "D_declared_checks", "G5_dim_seller_backfill", "S1_read_landing_split", "X1_category_margin", "X1_daily_rates", "X1_gmv_before_the_first_quote",
    "X1_gmv_in_currency", "X2_late_in_severe_weather",
    "X3_segment_moves", "X5_funnel", "X5_sessions", "X7_abandonment_rate", "X15_history_integrity",
    "X15_history_integrity_faults", "X17_unusual_days",
}
MAY_BE_EMPTY_WHEN_SMALL = {"J15_orphans", "X17_unusual_days", "D5_singular_faults", "X15_history_integrity_faults"}


@pytest.fixture(scope="module")
def duck(folder):
    with connect(folder) as con:
        yield con


@pytest.mark.parametrize("key", QUERIES)
def test_matches_sql(spark, duck, folder, key):
    df = QUERIES[key](spark, folder)
    text = plan_text(df)
    assert not [operator for operator in NEVER if operator in text]
    assert ("Window [" in text) == (key in WINDOWED)
    assert type_differences(df, duck, ORACLES[key]) == []
    rows = spark_result(df)
    assert differences(rows, duck, ORACLES[key]) == []
    if key in EMPTY_WHEN_CLEAN:
        assert rows.values == []
    elif key not in MAY_BE_EMPTY_WHEN_SMALL:
        assert rows.values


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_is_the_flagship_with_a_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["year_month", "seller_segment", "gmv", "items_vendidos", "ordenes"]
    assert not df.isEmpty()


def test_inputs_are_added_in_dependency_order():
    text = with_inputs("select * from d_customer")
    assert text.index("raw_orders as") < text.index("s_orders as") < text.index("d_customer as")


def test_scans_read_only_what_the_mart_needs(star):
    text = plan_text(star.plan("mart_segmento_vendedor"))
    columns = [set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<([^>]*)>", text)]
    assert {"date_sk", "seller_sk", "order_id", "order_item_id", "price"} in columns
    assert {"seller_sk", "seller_segment"} in columns
    assert "PushedFilters: [IsNotNull(date_sk), Not(EqualTo(date_sk,-1))" in text
