"""The daily stream: repeated, late and too late events."""

from datetime import date, datetime, timedelta

from dealscope.sources import warehouse
from dealscope.streaming import daily, feeds
from pyspark.sql import types as T

STAGES = ("a", "b")
SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                       T.StructField("stage_code", T.StringType())])
T0 = datetime(2024, 1, 10, 12)


def test_repeats_and_late_events(spark, tmp_path):
    landing, root = tmp_path / "landing", f"file://{tmp_path}/w"
    deliveries = [
        [(1, T0, "a"), (2, T0, "b"), (3, T0, "x"), (1, T0, "a"), (None, T0, "a"), (None, T0, "b")],
        [(1, T0, "a"), (4, T0 + timedelta(days=5), "a")],
        # Late by less than the watermark, then too late to count.
        [(5, T0 + timedelta(days=4), "b"), (6, T0 - timedelta(days=3), "b"), (4, T0 + timedelta(days=5), "a")],
    ]
    seen = []
    for rows in deliveries:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"file://{landing}")
        stream = feeds.read_feed(spark, f"file://{landing}", SCHEMA)
        daily.run_daily(daily.daily_counts(stream, STAGES, "2 days"), root, f"file://{tmp_path}/c",
                        feeds.AVAILABLE_NOW)
        seen.append({(r.day, r.stage_no): r.events for r in warehouse.read_mart(spark, root, "funnel_daily").collect()})
    day = date(2024, 1, 10)
    assert seen[0] == {(day, 1): 1, (day, 2): 1}
    assert seen[1] == {**seen[0], (date(2024, 1, 15), 1): 1}
    assert seen[2] == {**seen[1], (date(2024, 1, 14), 2): 1}
