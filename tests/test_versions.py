"""Latest version per key and the incremental boundary."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from dealscope.operators.versions import incremental, latest_by

T0 = datetime(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, updated_at timestamp, payload string")


def test_latest_wins_whatever_the_arrival(spark):
    rows = [(1, T0 + timedelta(1), "new"), (1, T0, "old"), (2, T0, "copy"), (2, T0, "copy"), (3, None, "x"),
            (3, T0, "dated")]
    got = {r.id: r.payload for r in latest_by(frame(spark, rows), ["id"], ["updated_at"]).collect()}
    assert got == {1: "new", 2: "copy", 3: "dated"}


def test_ties_do_not_depend_on_row_order(spark):
    rows = [(1, T0, f"p{n}") for n in range(50)]
    picks = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        picks.add(latest_by(frame(spark, rows).repartition(3), ["id"], ["updated_at"]).first().payload)
    assert len(picks) == 1


def test_boundary_rows_are_read_again(spark):
    rows = frame(spark, [(1, T0, "a"), (2, T0, "late"), (3, T0 - timedelta(1), "seen"), (4, T0 + timedelta(1), "b")])
    assert sorted(r.id for r in incremental(rows, "updated_at", T0).collect()) == [1, 2, 4]
    assert incremental(rows, "updated_at", None).count() == 4
    assert sorted(r.id for r in incremental(rows, "updated_at", T0, timedelta(1)).collect()) == [1, 2, 3, 4]


def test_rows_without_a_cursor_are_read_by_every_load(spark):
    rows = frame(spark, [(1, None, "a"), (2, T0, "b")])
    assert sorted(r.id for r in incremental(rows, "updated_at", T0 + timedelta(1)).collect()) == [1]


def test_best_row_is_picked_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = latest_by(rows, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2, plan
