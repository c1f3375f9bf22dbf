"""The funnel against a plain fold over each unit's history."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dealscope.operators import facts, funnel

STAGES = ("a", "b", "c", "d", "e")
T0 = datetime(2024, 1, 1)


def events(spark, rows):
    return spark.createDataFrame(rows, "agent_id long, ts timestamp, stage_code string")


def brute(rows, unit):
    reached, furthest, ordered = defaultdict(set), defaultdict(int), {}
    for agent, ts, code in rows:
        if code in STAGES:
            place = STAGES.index(code) + 1
            reached[place].add(unit(agent, ts))
            furthest[unit(agent, ts)] = max(furthest[unit(agent, ts)], place)
            ordered.setdefault(unit(agent, ts), []).append((ts, place))
    passed = defaultdict(int)
    for history in ordered.values():
        at = 0
        for _, place in sorted(history):
            at += place == at + 1
        for stage in range(1, at + 1):
            passed[stage] += 1
    n = range(1, 6)
    return ([len(reached[s]) for s in n], [sum(f >= s for f in furthest.values()) for s in n],
            [passed[s] for s in n])


def units(frame):
    return [r.units for r in frame.orderBy("stage_no").collect()]


def check(spark, rows, period, unit):
    frame = events(spark, rows)
    marks, paths = facts.stage_marks(frame, STAGES), funnel.stage_paths(frame, STAGES)
    reached, snapshot, ordered = brute(rows, unit)
    assert units(funnel.funnel_reached(marks, 5, period)) == reached
    assert units(funnel.funnel_snapshot(marks, 5, period)) == snapshot
    assert units(funnel.funnel_ordered(paths, 5, period)) == ordered
    rolled = facts.roll_up_marks(marks)
    assert units(funnel.funnel_reached(rolled, 5, period)) == reached
    assert units(funnel.funnel_snapshot(rolled, 5, period)) == snapshot
    assert snapshot == sorted(snapshot, reverse=True) and ordered == sorted(ordered, reverse=True)
    assert all(o <= s for o, s in zip(ordered, snapshot))


@pytest.mark.parametrize("rows, want", [
    ([(1, T0, "b"), (1, T0, "a")], [1, 1, 0, 0, 0]),
    ([(1, T0, "b"), (1, T0 + timedelta(1), "a")], [1, 0, 0, 0, 0]),
    ([(1, T0, "a"), (1, T0, "a"), (1, T0 + timedelta(days=2), "b"), (1, T0 + timedelta(days=9), "c")], [1, 1, 1, 0, 0]),
    ([(1, T0, "d"), (1, T0, "e"), (1, T0, "zzz")], [0, 0, 0, 0, 0]),
    ([(1, T0 + timedelta(microseconds=n), s) for n, s in enumerate("abcde")], [1, 1, 1, 1, 1]),
    ([(1, T0 + timedelta(microseconds=n), s) for n, s in enumerate("edcba")], [1, 0, 0, 0, 0]),
])
def test_ordered_by_hand(spark, rows, want):
    assert units(funnel.funnel_ordered(funnel.stage_paths(events(spark, rows), STAGES), 5)) == want


def test_against_brute_force_with_a_crowded_agent(spark):
    """A third of all rows belongs to one agent, many of them copies."""
    pick = random.Random(7)
    rows = []
    for _ in range(4000):
        agent = 0 if pick.random() < 0.34 else pick.randrange(1, 200)
        when = T0 + timedelta(seconds=pick.randrange(40 * 86400) // 600 * 600, microseconds=pick.randrange(3))
        rows.append((agent, when, pick.choice((*STAGES, "other"))))
    rows += [rows[0]] * 500
    check(spark, rows, None, lambda agent, ts: agent)
    check(spark, rows, "week", lambda agent, ts: (agent, (ts - timedelta(ts.weekday())).date()))
    check(spark, rows, "month", lambda agent, ts: (agent, ts.year, ts.month))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(0, 200_000), st.sampled_from([*STAGES, "x"])),
                min_size=1, max_size=60))
def test_any_history(spark, raw):
    rows = [(agent, T0 + timedelta(seconds=second), code) for agent, second, code in raw]
    check(spark, rows, None, lambda agent, ts: agent)


def test_no_units_gives_zeros_and_null_rates(spark):
    empty = facts.stage_marks(events(spark, [(1, T0, "other")]), STAGES)
    rows = funnel.funnel_snapshot(empty, 5).collect()
    assert [(r.units, r.conv_prev, r.conv_top) for r in rows] == [(0, None, None)] * 5


def test_by_agency_and_period(spark):
    rows = [(1, T0, "a"), (1, T0 + timedelta(7), "b"), (2, T0, "c"), (3, T0, "a")]
    agents = spark.createDataFrame([(1, "x"), (2, "x")], "agent_id long, agency_id string")
    marks = facts.stage_marks(events(spark, rows), STAGES)
    got = {(r.agency_id, str(r.period), r.stage_no): r.units
           for r in funnel.funnel_snapshot(marks, 5, "week", agents, by_period=True).collect()}
    assert len(got) == 3 * 5
    assert got["x", "2024-01-01", 1] == 2 and got["x", "2024-01-01", 3] == 1
    assert got["x", "2024-01-08", 2] == 1 and got["x", "2024-01-08", 3] == 0
    assert got[None, "2024-01-01", 1] == 1
