"""Intervals and the join on key and moment, against a plain search; bitmaps against distinct counts."""

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from dealscope.operators import unit_bitmaps, validity

T0 = datetime(2024, 1, 1)


def test_a_row_gets_what_its_key_had_then(spark):
    dice = random.Random(2)
    moment = lambda: T0 + timedelta(days=dice.randrange(400), seconds=dice.choice([0, 0, 3600]))
    versions = [(dice.choice([None, 1, 2, 3, 4]), dice.choice(["a", "b", "c", None]), dice.choice([None] + [moment() for _ in range(9)]))
                for _ in range(60)]
    rows = [(n, dice.choice([None, 1, 1, 1, 1, 2, 3, 4, 5]), dice.choice([moment(), moment(), None])) for n in range(400)]
    rows += [(1000 + n, v[0], v[2]) for n, v in enumerate(versions)]

    def plain(key, at):
        if key is None or at is None:
            return None
        own = {}
        for k, value, since in versions:
            if k == key:
                own[since] = max([v for v in (own.get(since), value) if v is not None], default=None)
        order = sorted(own, key=lambda s: (s is not None, s))
        found = None
        for place, since in enumerate(order):
            if place == 0 or since <= at:
                found = own[since]
        return found

    periods = validity.intervals(spark.createDataFrame(versions, "id long, value string, since timestamp"), "id", "value", "since")
    frame = spark.createDataFrame(rows, "n long, id long, at timestamp").withColumn("value", F.lit("old"))
    for days in (7, 90, 4000):
        got = {r.n: r.value for r in validity.valid_at(frame, periods, "id", "at", ["value"], days).collect()}
        assert got == {n: plain(key, at) for n, key, at in rows}
    assert validity.valid_at(frame.where("false"), periods, "id", "at", ["value"]).collect() == []
    assert {r.value for r in validity.valid_at(frame, periods.where("false"), "id", "at", ["value"]).collect()} == {None}


def test_a_hot_key_is_split_by_time(spark):
    versions = spark.createDataFrame([(1, "a", T0), (1, "b", T0 + timedelta(days=100))], "id long, value string, since timestamp")
    periods = validity.intervals(versions, "id", "value", "since")
    rows = spark.range(2000).select((F.floor(F.col("id") / 10**9) + 1).alias("id"), (F.lit(T0) + F.expr("make_dt_interval(cast(id % 200 as int))")).alias("at"))
    joined = validity.valid_at(rows, periods, "id", "at", ["value"], 10)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "_bucket" in plan and "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert {r.value: r["count"] for r in joined.groupBy("value").count().collect()} == {"a": 1000, "b": 1000}


def test_distinct_agents_of_any_days(spark):
    dice = random.Random(4)
    ids = [0, 1, 7, 32767, 32768, 10**12, -5, None]
    rows = [(n, dice.choice(ids), dice.choice([T0 + timedelta(hours=dice.randrange(600)), None]), dice.choice("abx")) for n in range(500)]
    frame = spark.createDataFrame(rows, "event_id long, agent_id long, ts timestamp, stage_code string")
    bitmaps = unit_bitmaps.daily_bitmaps(frame, ("a", "b"))
    for first, last in ((None, None), (date(2024, 1, 5), date(2024, 1, 9)), (date(2024, 1, 20), None)):
        seen = {}
        for _, agent, ts, code in rows:
            if agent is not None and ts is not None and code in "ab" and (first is None or ts.date() >= first) and (
                    last is None or ts.date() <= last):
                seen.setdefault("ab".index(code) + 1, set()).add(agent)
        got = {r.stage_no: r.units for r in unit_bitmaps.distinct_units(bitmaps, first, last).collect()}
        assert got == {s: len(a) for s, a in seen.items()}
