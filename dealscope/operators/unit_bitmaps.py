"""Exact distinct agents per stage over any range of days, from bitmaps stored per day.

A bitmap holds BITMAP_BITS neighbouring ids, so a day has one row per stage and
block of ids in which anyone was seen. Bitmaps of days merge by a bitwise or, which
Spark combines per task; counts of the blocks then add up, so nobody is counted
twice however many days a report spans.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealscope.operators.facts import stage_number


def daily_bitmaps(events: DataFrame, stages: Sequence[str]) -> DataFrame:
    """``day, stage_no, block, ids``: who touched a stage on a day. Events without an agent, a time or a stage of the list
    take no part."""
    kept = events.where(F.col("stage_code").isin(list(stages)) & F.col("ts").isNotNull() & F.col("agent_id").isNotNull())
    return kept.groupBy(
        F.col("ts").cast("date").alias("day"), stage_number(F.col("stage_code"), stages).cast("bigint").alias("stage_no"),
        F.bitmap_bucket_number("agent_id").alias("block")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("agent_id")).alias("ids"))


def merged(bitmaps: DataFrame, *dims: str | Column) -> DataFrame:
    """Bitmaps of coarser groups: ``dims, stage_no, block, ids``."""
    return bitmaps.groupBy(*dims, "stage_no", "block").agg(F.bitmap_or_agg("ids").alias("ids"))


def distinct_units(bitmaps: DataFrame, first: date | None = None, last: date | None = None, *dims: str | Column) -> DataFrame:
    """``dims, stage_no, units``: distinct agents per stage from day ``first`` to day ``last``, both included."""
    days = bitmaps
    if first is not None:
        days = days.where(F.col("day") >= F.lit(first))
    if last is not None:
        days = days.where(F.col("day") <= F.lit(last))
    names = [d if isinstance(d, str) else d for d in dims]
    blocks = merged(days, *names)
    groups = [c for c in blocks.columns if c not in ("block", "ids")]
    return blocks.groupBy(*groups).agg(F.sum(F.bitmap_count("ids")).cast("bigint").alias("units"))
