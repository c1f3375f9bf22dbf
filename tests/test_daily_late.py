"""The daily stream that counts every event, however late and in whatever batches."""

from datetime import date, datetime, timedelta

from dealscope.sources import warehouse
from dealscope.streaming import daily, feeds

STAGES = ("a", "b")
T0 = datetime(2024, 1, 10, 12)


def test_no_event_is_too_late(spark, tmp_path):
    landing, root = tmp_path / "landing", f"file://{tmp_path}/w"
    schema = "event_id long, ts timestamp_ntz, stage_code string"
    deliveries = [
        [(1, T0 + timedelta(days=60), "a"), (2, T0 + timedelta(days=60), "x"), (None, T0, "a")],
        [(3, T0, "b"), (4, T0, "a"), (4, T0, "a")],
        [(3, T0, "b"), (5, T0 + timedelta(days=1), "b"), (6, T0, "a"), (7, None, "a")],
        [(2, T0, "x")],
    ]
    for rows in deliveries:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"file://{landing}")
        # A file a batch: the first one has the newest event.
        stream = feeds.read_feed(spark, f"file://{landing}", spark.createDataFrame([], schema).schema, max_files=1)
        daily.keep_daily(stream, STAGES, root, f"file://{tmp_path}/c", feeds.AVAILABLE_NOW)
    got = {(r.day, r.stage_no): r.events for r in warehouse.read_mart(spark, root, "funnel_daily").collect()}
    assert got == {(date(2024, 3, 10), 1): 1, (date(2024, 1, 10), 1): 2, (date(2024, 1, 10), 2): 1,
                   (date(2024, 1, 11), 2): 1, (None, 1): 1}
