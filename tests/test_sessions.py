"""Sessions against brute force, batch against stream."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import sessions as S
from lakeloom.streaming import funnel as streaming

T0 = datetime(2024, 1, 1, 12, 0, 0)
SCHEMA = "event_id bigint, user_id bigint, ts timestamp, step string"


def minutes(*values):
    return [T0 + timedelta(minutes=m) for m in values]


def clicks(spark, rows):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], SCHEMA)


def brute(rows, gap=timedelta(minutes=30)):
    found = []
    for user in sorted({r[0] for r in rows}):
        times = sorted(r[1] for r in rows if r[0] == user)
        current = [times[0]]
        for t in times[1:]:
            if t - current[-1] > gap:
                found.append((user, current[0], current[-1], len(current)))
                current = []
            current.append(t)
        found.append((user, current[0], current[-1], len(current)))
    return sorted(found)


def found_by(df):
    return sorted((r.user_id, r.session_start, r.session_end, r.events) for r in df.collect())


def test_exact_gap_stays_and_a_microsecond_more_opens(spark):
    rows = [(1, t, "view") for t in minutes(0, 30, 60)]
    rows.append((1, T0 + timedelta(minutes=90, microseconds=1), "view"))
    assert found_by(S.sessions(clicks(spark, rows))) == brute(rows)
    assert len(brute(rows)) == 2


def test_sessions_equal_brute_force_with_a_hot_user(spark):
    rows = [(7, T0 + timedelta(seconds=37 * i), "view") for i in range(400)]  # one long session
    rows += [(7, T0 + timedelta(hours=30, minutes=31 * i), "cart") for i in range(20)]  # all alone
    rows += [(u, T0 + timedelta(minutes=(u * 13 * i) % 1700), "view") for u in range(1, 7) for i in range(40)]
    rows += [(8, datetime(1970, 1, 1) + timedelta(minutes=m), "view") for m in (-75, -29, -1, 28, 59, 61)]
    assert found_by(S.sessions(clicks(spark, rows))) == brute(rows)


def test_funnel_counts_steps_in_order_only(spark):
    steps = {
        1: ["view", "cart", "checkout", "payment"],
        2: ["view", "cart"],
        3: ["cart", "view"],  # cart before the view
        4: ["view", "checkout"],  # skips a step
        5: [None],
    }
    rows = [(u, t, s) for u, listed in steps.items() for t, s in zip(minutes(*range(len(listed))), listed)]
    found = S.sessions(clicks(spark, rows))
    report = {r.step: (r.reached, r.conversion) for r in S.funnel(found).collect()}
    assert report == {"view": (4, 0.8), "cart": (2, 0.5), "checkout": (1, 0.5), "payment": (1, 1.0)}
    rate = S.abandonment_rate(found).first()
    assert (rate.carts, rate.abandoned) == (3, 2)


def test_conversion_without_sessions_is_null(spark):
    report = S.funnel(S.sessions(clicks(spark, [(1, T0, None)]).where("step is not null")))
    assert {r.conversion for r in report.collect()} == {None}


def stored(spark, folder, rows):
    clicks(spark, rows).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).parquet(folder)


def test_stream_emits_each_closed_session_once_over_restarts(spark, tmp_path):
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    first = [(1, t, "view") for t in minutes(0, 10, 50)] + [(2, t, "cart") for t in minutes(5, 40)]
    stored(spark, source, first)
    streaming.run_available(streaming.closed_sessions(stream(spark, source)), target)
    second = [(1, t, "payment") for t in minutes(70)] + [(3, t, "view") for t in minutes(200)]
    stored(spark, source, second)
    done = streaming.run_available(streaming.closed_sessions(stream(spark, source)), target)
    expected = brute([*first, *second])
    # The session of user 3 is still open; every other one is out exactly once and complete.
    assert found_by(done) == [s for s in expected if s[0] != 3]


def test_stream_accepts_late_clicks_within_the_delay(spark, tmp_path):
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    stored(spark, source, [(1, T0, "view"), (2, T0 + timedelta(minutes=32), "view")])
    streaming.run_available(streaming.closed_sessions(stream(spark, source)), target)
    late = (1, T0 + timedelta(minutes=29, seconds=59), "cart")
    stored(spark, source, [late, (2, T0 + timedelta(hours=5), "view")])
    done = streaming.run_available(streaming.closed_sessions(stream(spark, source)), target)
    assert (1, T0, late[1], 2) in found_by(done)


def test_stream_equals_batch_after_a_later_event(spark, star, tmp_path):
    events = star.raw.clicks
    last = events.agg(F.max("ts")).first()[0]
    flush = clicks(spark, [(10**9, last + timedelta(days=1), None)]).select("event_id", "user_id", "ts", "step")
    source = f"{tmp_path}/in"
    events.select(*flush.columns).unionByName(flush).coalesce(1).write.parquet(source)
    done = streaming.run_available(streaming.closed_sessions(stream(spark, source)), f"{tmp_path}/out")
    assert found_by(done) == found_by(S.sessions(events))


@pytest.mark.parametrize("gap", [1, 30, 600])
def test_gap_is_a_parameter(spark, star, gap):
    sample = star.raw.clicks.select("user_id", "ts", "step")
    rows = [(r.user_id, r.ts, r.step) for r in sample.collect()]
    assert found_by(S.sessions(star.raw.clicks, gap)) == brute(rows, timedelta(minutes=gap))


def test_step_counts_are_out_with_the_first_batch(spark, tmp_path):
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"

    def counts():
        running = streaming.start_updates(streaming.step_counts(stream(spark, source)), target, availableNow=True)
        running.awaitTermination()
        return {(r.window_start, r.step): r.clicks for r in streaming.latest_counts(spark, target).collect()}

    stored(spark, source, [(1, T0, "view"), (2, T0 + timedelta(minutes=1), "view")])
    assert counts() == {(T0, "view"): 2}
    stored(spark, source, [(3, T0 + timedelta(minutes=2), "view"), (1, T0 + timedelta(minutes=6), "cart")])
    assert counts() == {(T0, "view"): 3, (T0 + timedelta(minutes=5), "cart"): 1}


def test_a_recovery_is_out_before_its_session_closes(spark, tmp_path):
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    # User 1 goes on looking, user 2 pays in time, user 3 too late, user 4 pays before the cart.
    stored(spark, source, [
        *[(1, t, s) for t, s in zip(minutes(0, 20), ("cart", "view"))], (2, T0, "cart"), (2, T0 + timedelta(minutes=29), "payment"),
        (3, T0, "cart"), (3, T0 + timedelta(minutes=30), "payment"), (4, T0 + timedelta(minutes=1), "cart"), (4, T0, "payment"),
    ])
    run = lambda: streaming.run_available(streaming.recovery_triggers(stream(spark, source)), target)
    assert run().isEmpty()
    stored(spark, source, [(1, T0 + timedelta(minutes=28), "view"), (9, T0 + timedelta(minutes=34), "view")])
    due = sorted((r.user_id, r.cart_at) for r in run().collect())
    assert due == [(1, T0), (3, T0), (4, T0 + timedelta(minutes=1))]
    # Its session is open until 58 minutes have gone: no closed session holds the cart yet.
    closed = streaming.run_available(streaming.closed_sessions(stream(spark, source)), f"{tmp_path}/closed")
    assert closed.where("user_id = 1").isEmpty()
    stored(spark, source, [(9, T0 + timedelta(hours=3), "view")])
    assert run().count() == 3
