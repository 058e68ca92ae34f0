"""Type-2 history: merging step by step, in bulk, and loading into a table."""

from __future__ import annotations

from datetime import date
from functools import reduce

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeloom.operators.dimension import as_of_date, point_in_time
from lakeloom.operators.history import (
    HistorySpec,
    first_load,
    history_from_snapshots,
    history_violations,
    merge_snapshot,
)
from lakeloom.plans.build import load_history
from lakeloom.sources import tables

SPEC = HistorySpec(natural="k", surrogate="sk", tracked=["a", "b"], carried=["amount"])
DAYS = [date(2020, m, 1) for m in (1, 4, 7, 10)]


def snapshot(spark, rows):
    return spark.createDataFrame(rows, "k string, a string, b string, amount int")


def merged(spark, snapshots):
    (first_day, first), *later = snapshots
    return reduce(lambda h, s: merge_snapshot(h, snapshot(spark, s[1]), SPEC, s[0]), later, first_load(snapshot(spark, first), SPEC))


def bulk(spark, snapshots):
    rows = [(day, *row) for day, found in snapshots for row in found]
    stacked = spark.createDataFrame(rows, "as_of date, k string, a string, b string, amount int")
    return history_from_snapshots(stacked, SPEC, snapshots[0][0])


def rows(df):
    return sorted((tuple(r) for r in df.select(*SPEC.columns).collect()), key=repr)


STORY = [
    (DAYS[0], [("x", "1", None, 1), ("y", "1", "1", 1), ("z", "1", "1", 1), ("-1", "U", "U", 0)]),
    (DAYS[1], [("x", "1", "now", 2), ("y", "1", "1", 9), ("-1", "U", "U", 0)]),  # z is missing
    (DAYS[2], [("x", None, "now", 3), ("y", "2", "1", 3), ("z", "1", "1", 5), ("new", "1", "1", 3), ("-1", "U", "U", 0)]),
    (DAYS[3], [("x", "1", None, 1), ("y", "2", "1", 3), ("z", "2", "1", 5), ("new", "1", "1", 4), ("-1", "U", "U", 0)]),
]


def test_merging_equals_the_bulk_build(spark):
    assert rows(merged(spark, STORY)) == rows(bulk(spark, STORY))


def test_versions_of_the_story(spark):
    history = merged(spark, STORY)
    spans = {}
    for r in history.orderBy("k", "valid_from").collect():
        spans.setdefault(r.k, []).append((r.valid_from.isoformat(), r.valid_to.isoformat(), r.a, r.b, r.amount))
    assert spans["x"] == [
        ("1900-01-01", "2020-03-31", "1", None, 1),
        ("2020-04-01", "2020-06-30", "1", "now", 2),
        ("2020-07-01", "2020-09-30", None, "now", 3),
        ("2020-10-01", "9999-12-31", "1", None, 1),
    ]
    # The amount alone opens no version and is not refreshed; a missing member stays current.
    assert spans["y"][0] == ("1900-01-01", "2020-06-30", "1", "1", 1)
    assert [s[0] for s in spans["z"]] == ["1900-01-01", "2020-10-01"]
    assert spans["new"] == [("2020-07-01", "9999-12-31", "1", "1", 3)]
    assert history_violations(history, SPEC).isEmpty()
    keys = [r.sk for r in history.select("sk").collect()]
    assert len(keys) == len(set(keys)) and "-1" in keys


member = st.tuples(st.sampled_from("pqr"), st.sampled_from([None, "1", "2"]), st.sampled_from([None, "1"]))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(st.sampled_from("pqr"), member, min_size=1), min_size=2, max_size=4))
def test_merging_equals_the_bulk_build_on_random_snapshots(spark, found):
    story = [(day, [(k, v[1], v[2], i) for k, v in sorted(s.items())]) for i, (day, s) in enumerate(zip(DAYS, found))]
    history = merged(spark, story)
    assert rows(history) == rows(bulk(spark, story))
    assert history_violations(history, SPEC).isEmpty()


def test_load_reports_repeats_and_refuses(spark, tmp_path):
    root = str(tmp_path)
    loads = [load_history(root, "dim", snapshot(spark, found), SPEC, day) for day, found in STORY]
    assert loads == [
        {"inserted": 4, "closed": 0, "changed_detected": 0},
        {"inserted": 1, "closed": 1, "changed_detected": 1},
        {"inserted": 3, "closed": 2, "changed_detected": 2},
        {"inserted": 2, "closed": 2, "changed_detected": 2},
    ]
    before = rows(tables.read_table(spark, root, "dim"))
    assert before == rows(bulk(spark, STORY))
    repeated = load_history(root, "dim", snapshot(spark, STORY[3][1]), SPEC, DAYS[3])
    assert repeated == {"inserted": 0, "closed": 0, "changed_detected": 0}
    with pytest.raises(ValueError, match="rewrite the past"):
        load_history(root, "dim", snapshot(spark, STORY[2][1]), SPEC, DAYS[2])
    with pytest.raises(ValueError, match="rewrite the past"):
        load_history(root, "dim", snapshot(spark, STORY[2][1]), SPEC, DAYS[3])
    assert rows(tables.read_table(spark, root, "dim")) == before


def test_facts_find_the_version_of_their_day_and_none_is_lost(spark):
    history = merged(spark, STORY)
    facts = spark.createDataFrame(
        [(1, "x", date(2020, 3, 31)), (2, "x", date(2020, 4, 1)), (3, "new", date(2020, 1, 1)), (4, "x", None), (5, None, date(2020, 1, 1))],
        "id int, k string, on_day date",
    )
    found = {r.id: r.b for r in point_in_time(facts, history, "k", "on_day", ["b"]).collect()}
    assert found == {1: None, 2: "now", 3: None, 4: None, 5: None}
    matched = point_in_time(facts, history, "k", "on_day", ["sk"]).where("sk is not null").count()
    assert matched == 2


def test_as_of_date_has_one_row_per_member_known_then(spark):
    history = merged(spark, STORY)
    assert sorted(r.k for r in as_of_date(history, date(2020, 5, 5)).collect()) == ["-1", "x", "y", "z"]


def test_violations_are_found(spark):
    faulty = spark.createDataFrame(
        [
            ("two", date(2020, 1, 1), date(2020, 2, 1), True),
            ("two", date(2020, 3, 1), date(9999, 12, 31), True),
            ("over", date(2020, 1, 1), date(2020, 3, 1), False),
            ("over", date(2020, 3, 1), date(9999, 12, 31), True),
            ("turned", date(2020, 3, 1), date(2020, 2, 1), True),
            ("good", date(2020, 1, 1), date(9999, 12, 31), True),
        ],
        "k string, valid_from date, valid_to date, is_current boolean",
    )
    found = {r.k: (r.current_rows, r.inverted, r.overlapping) for r in history_violations(faulty, SPEC).collect()}
    assert found == {"two": (2, 0, 0), "over": (1, 0, 1), "turned": (1, 1, 0)}
