"""Daily stage counts of an event stream whose deliveries repeat and come late.

:func:`keep_daily` counts every event, however late. :func:`daily_counts` holds
nothing but the open days and leaves out what comes after the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealscope.operators.facts import stage_number
from dealscope.operators.versions import latest_by
from dealscope.sources import warehouse

TABLE = "mart/funnel_daily"
#: The counted events, in blocks of a day.
EVENTS = "staging/daily_event"
# The block of events without a time.
NO_DAY = "none"


def daily_counts(events: DataFrame, stages: tuple[str, ...], lateness: str) -> DataFrame:
    """``day, stage_no, events`` of a stream with ``event_id, ts, stage_code``.

    An event delivered again within ``lateness`` counts once, an event later
    than that is not counted. Nor is one without an id, as in staging: it can't
    be told from its copies. Both the ids remembered and the open days are
    bounded by the watermark. Days are those of the session's time zone: Spark's
    windows start at midnight UTC, so the time is moved there and back.
    """
    zone = F.current_timezone()
    return (
        events.where(F.col("stage_code").isin(list(stages)) & F.col("event_id").isNotNull())
        .withColumn("ts", F.from_utc_timestamp(F.col("ts").cast("timestamp"), zone))
        .withWatermark("ts", lateness)
        .dropDuplicatesWithinWatermark(["event_id"])
        .groupBy(F.window("ts", "1 day").alias("window"), stage_number(F.col("stage_code"), stages).alias("stage_no"))
        .agg(F.count("*").alias("events"))
        .select(
            F.to_utc_timestamp("window.start", zone).cast("date").alias("day"),
            F.col("stage_no").cast("bigint").alias("stage_no"),
            "events",
        )
    )


def run_daily(counts: DataFrame, root: str, checkpoint: str, trigger: dict) -> None:
    """Keep the mart under its own ``root`` up to date with the stream.

    A batch brings the new counts of the days it changed. The mart has five rows
    per day, so it is merged and published whole.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("age", F.lit(1))
        before = warehouse.read_table(spark, root, TABLE)
        if before is not None:
            rows = rows.unionByName(before.withColumn("age", F.lit(0)))
        rows = latest_by(rows, ["day", "stage_no"], ["age"]).drop("age")
        warehouse.write_atomic(rows, root, TABLE, batch_id, warehouse.query_of(spark))

    query = (
        counts.writeStream.outputMode("update").trigger(**trigger)
        .option("checkpointLocation", checkpoint).foreachBatch(merge).start()
    )
    query.awaitTermination()


def keep_daily(events: DataFrame, stages: tuple[str, ...], root: str, checkpoint: str, trigger: dict,
               keep: int = 144) -> None:
    """Keep ``day, stage_no, events`` under ``root`` equal to a count of all ``events`` that ever came.

    The events (``event_id, ts, stage_code``) are kept in blocks of a day. A batch
    rewrites the days it brings events of, old or new, and counts those again; an
    event delivered again for its day counts once. One without an id is not
    counted, as in staging; one without a time counts under no day. The files of
    the last ``keep`` batches stay for readers that began on them.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        number = warehouse.next_batch(spark, root, warehouse.query_of(spark), batch_id)
        if number is None:
            return
        ts = F.col("ts").cast("timestamp")
        new = batch.where(F.col("stage_code").isin(list(stages)) & F.col("event_id").isNotNull()).select(
            "event_id", ts.alias("ts"), ts.cast("date").alias("day"),
            stage_number(F.col("stage_code"), stages).cast("bigint").alias("stage_no"))
        block = F.coalesce(F.date_format("day", "yyyy-MM-dd"), F.lit(NO_DAY))
        touched = sorted(r[0] for r in new.select(block).distinct().collect())
        if not touched:
            return
        before = warehouse.read_table(spark, root, EVENTS, touched)
        rows = latest_by(new if before is None else new.unionByName(before), ["day", "event_id"], ["ts"])
        # Small days share a task, large ones fill several.
        warehouse.write_snapshot(rows.withColumn("block", block).hint("rebalance", "block"), root, EVENTS, number, "block")
        written = warehouse.read_batch(spark, root, EVENTS, number)
        counts = written.groupBy("day", "stage_no").agg(F.count(F.lit(1)).alias("events"))
        mart = warehouse.read_table(spark, root, TABLE)
        if mart is not None:
            counts = counts.unionByName(mart.where(~block.isin(touched)))
        warehouse.write_snapshot(counts, root, TABLE, number)
        warehouse.publish(spark, root, number, {EVENTS: dict.fromkeys(touched, number), TABLE: {warehouse.WHOLE: number}},
                          source=(warehouse.query_of(spark), batch_id))
        warehouse.expire(spark, root, keep)

    query = (
        events.writeStream.trigger(**trigger).option("checkpointLocation", checkpoint).foreachBatch(merge).start()
    )
    query.awaitTermination()
