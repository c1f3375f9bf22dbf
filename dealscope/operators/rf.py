"""Recency-frequency segmentation."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealscope.operators.facts import as_of, attribute

# Our own cut points: upper bounds of recency bins in days, and lower bounds of
# frequency bins in deals, best bin first.
RECENCY_CUTS = (90, 180, 365)
FREQUENCY_CUTS = (12, 9, 6)


def rf_measures(facts: DataFrame, asof: date | None = None, agents: DataFrame | None = None) -> DataFrame:
    """``id, recency_days, frequency`` per agent, or per agency when ``agents`` is given."""
    last = as_of(facts, asof)
    by = "agent_id"
    seen = facts.where((F.col("deal_date") <= last) & F.col("agent_id").isNotNull())
    grouped = seen.groupBy(by).agg(F.max("deal_date").alias("latest"), F.sum("deals").alias("frequency"))
    if agents is not None:
        by = "agency_id"
        grouped = attribute(grouped, agents).where(F.col(by).isNotNull()).groupBy(by).agg(
            F.max("latest").alias("latest"), F.sum("frequency").alias("frequency"))
    return grouped.select(
        by,
        F.datediff(last, F.col("latest")).cast("bigint").alias("recency_days"),
        F.col("frequency").cast("bigint").alias("frequency"),
    )


def rf_segment(facts: DataFrame, r_cuts: Sequence[int] = RECENCY_CUTS, f_cuts: Sequence[int] = FREQUENCY_CUTS,
               asof: date | None = None, agents: DataFrame | None = None) -> DataFrame:
    """Measures with their bins: ``id, recency_days, frequency, r_bin, f_bin``."""
    return binned(rf_measures(facts, asof, agents), r_cuts, f_cuts)


def binned(measures: DataFrame, r_cuts: Sequence[int] = RECENCY_CUTS, f_cuts: Sequence[int] = FREQUENCY_CUTS) -> DataFrame:
    """``measures`` with ``r_bin`` and ``f_bin``."""
    recency, frequency = F.col("recency_days"), F.col("frequency")
    return measures.select(
        "*",
        _bin([recency <= cut for cut in r_cuts]).alias("r_bin"),
        _bin([frequency >= cut for cut in f_cuts]).alias("f_bin"),
    )


def rf_matrix(facts: DataFrame, r_cuts: Sequence[int] = RECENCY_CUTS, f_cuts: Sequence[int] = FREQUENCY_CUTS,
              asof: date | None = None, agents: DataFrame | None = None) -> DataFrame:
    """``r_bin, f_bin, n`` with a row for every cell, empty ones included.

    The grid enters as zeros before the sum, so no join is needed.
    """
    cells = rf_segment(facts, r_cuts, f_cuts, asof, agents).select(
        "r_bin", "f_bin", F.lit(1).cast("bigint").alias("n"))
    return grid(cells, r_cuts, f_cuts)


def grid(cells: DataFrame, r_cuts: Sequence[int] = RECENCY_CUTS, f_cuts: Sequence[int] = FREQUENCY_CUTS) -> DataFrame:
    """Sums of ``n`` by cell, with zeros for the cells that ``cells`` lacks."""
    width = len(f_cuts) + 1
    place = cells.sparkSession.range((len(r_cuts) + 1) * width, numPartitions=1)
    zeros = place.select(
        (F.floor(F.col("id") / width) + 1).cast("bigint").alias("r_bin"),
        (F.col("id") % width + 1).cast("bigint").alias("f_bin"),
        F.lit(0).cast("bigint").alias("n"),
    )
    return cells.unionByName(zeros).groupBy("r_bin", "f_bin").agg(F.sum("n").cast("bigint").alias("n"))


def rf_cuts(facts: DataFrame, quantiles: Sequence[float], asof: date | None = None,
            agents: DataFrame | None = None) -> DataFrame:
    """Exact, interpolated quantiles of both measures: ``measure, q, cut``.

    The percentile works on a histogram made beforehand. Its size is bounded:
    recency has one entry per calendar day, and ``n`` deals allow at most
    ``sqrt(2n)`` distinct frequencies.
    """
    pairs = rf_measures(facts, asof, agents).select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("measure"), F.col(name).alias("value"))
        for name in ("recency_days", "frequency")
    ])))
    counts = pairs.groupBy("measure", "value").agg(F.count("*").alias("n"))
    wanted = F.array(*[F.lit(float(q)) for q in quantiles])
    cuts = counts.groupBy("measure").agg(F.percentile("value", wanted, F.col("n")).alias("cuts"))
    return cuts.select("measure", F.inline(F.arrays_zip(wanted.alias("q"), F.col("cuts").alias("cut")))).select(
        "measure", F.col("q").cast("double").alias("q"), F.col("cut").cast("double").alias("cut"))


def _bin(conditions: Sequence[Column]) -> Column:
    number = F.lit(len(conditions) + 1)
    for place in range(len(conditions), 0, -1):
        number = F.when(conditions[place - 1], place).otherwise(number)
    return number.cast("bigint")
