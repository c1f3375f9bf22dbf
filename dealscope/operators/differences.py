"""Marts from states that are patched by signed differences.

A changed block of facts gives its old rows with weight -1 and its new rows with
weight +1. Sums by agent and day are patched with the summed weights, and so are
cells: counts of agents (or agencies, or funnel units) with something in common.
Only keys that a difference names are looked at, with all their days before and
after, so what isn't a sum over days (first deals, cohorts, gaps) is retracted
and counted anew for them alone. Cells are as few as the calendar allows:

* gaps, ``day, next_day, n``: keys with deals on both days and on none between. A key
  is active in a window just if it has one gap that starts in it and ends beyond,
  so activity in any window is counted exactly, whatever the reference date.
* ``latest, frequency, n``: keys with the last deal on that day and so many deals.
* ``cohort, k, n``: keys of a cohort that were active k periods on.
* ``[period], mask, stage, n``: funnel units that touched these stages and came so far in order.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealscope.operators import cohort, rf
from dealscope.operators.facts import VOLUME

MEASURES = ("deals", "won_deals", "volume")


def signed(old: DataFrame | None, new: DataFrame | None, weight: str = "w") -> DataFrame | None:
    """Old rows with ``weight`` -1 and new ones with 1; either may be missing."""
    parts = [rows.withColumn(weight, F.lit(sign).cast("bigint")) for rows, sign in ((old, -1), (new, 1)) if rows is not None]
    return reduce(DataFrame.unionByName, parts) if parts else None


def day_changes(old: DataFrame | None, new: DataFrame | None, key: str) -> DataFrame | None:
    """``key, deal_date`` and by how much their measures changed; rows that didn't change are left out."""
    rows = signed(old, new)
    if rows is None:
        return None
    sums = [F.sum(F.col(m) * F.col("w")).cast(VOLUME if m == "volume" else "bigint").alias(m) for m in MEASURES]
    return rows.groupBy(key, "deal_date").agg(*sums).where(" OR ".join(f"{m} <> 0" for m in MEASURES))


def patched_days(days: DataFrame | None, changes: DataFrame, key: str, *extra: str) -> DataFrame:
    """Days of all keys after the changes; days that are left without deals are gone."""
    columns = [key, "deal_date", *MEASURES, *extra]
    rows = changes.select(*columns)
    rows = rows if days is None else rows.unionByName(days.select(*columns))
    sums = [F.sum(m).cast(VOLUME if m == "volume" else "bigint").alias(m) for m in MEASURES]
    return rows.groupBy(key, "deal_date", *extra).agg(*sums).where("deals <> 0")


def totals(days: DataFrame, key: str, *extra: str) -> DataFrame:
    """``key, first, latest, frequency, deals, volume``: first and last day, dated deals, and won deals with their volume."""
    return days.groupBy(key, *extra).agg(
        F.min("deal_date").alias("first"), F.max("deal_date").alias("latest"),
        F.coalesce(F.sum(F.when(F.col("deal_date").isNotNull(), F.col("deals"))), F.lit(0)).cast("bigint").alias("frequency"),
        F.sum("won_deals").cast("bigint").alias("deals"), F.sum("volume").cast(VOLUME).alias("volume"))


def gap_cells(days: DataFrame, key: str, *weight: str) -> DataFrame:
    """``day, next_day`` of each key, the last day with null. A key has at most one row a day."""
    after = F.lead("deal_date").over(Window.partitionBy(key, *weight).orderBy("deal_date"))
    return days.where(F.col(key).isNotNull() & F.col("deal_date").isNotNull()).select(
        F.col("deal_date").alias("day"), after.alias("next_day"), *weight)


def rf_cells(days: DataFrame, key: str, *weight: str) -> DataFrame:
    """``latest, frequency`` of each key with a dated deal."""
    return totals(days.where(F.col(key).isNotNull() & F.col("deal_date").isNotNull()), key, *weight).select(
        "latest", "frequency", *weight)


def cohort_cells(days: DataFrame, key: str, grain: str, *weight: str) -> DataFrame:
    """``cohort, k`` of each key and period; a key without dated deals has one row with nulls."""
    named = days.where(F.col(key).isNotNull())
    periods = named.select(key, *weight, F.trunc("deal_date", grain).alias("period")).distinct()
    first = F.min("period").over(Window.partitionBy(key, *weight))
    return periods.withColumn("cohort", first).where(F.col("period").isNotNull() | F.col("cohort").isNull()).select(
        "cohort", cohort._distance(F.col("cohort"), F.col("period"), grain).alias("k"), *weight)


def cell_changes(rows: DataFrame, dims: Sequence[str], weight: str = "w", count: Column | None = None) -> DataFrame:
    """``dims, n``: by how much each cell changed."""
    weighted = F.col(weight) if count is None else F.col(weight) * count
    return rows.groupBy(*dims).agg(F.sum(weighted).cast("bigint").alias("n")).where("n <> 0")


def patched_cells(cells: DataFrame | None, changes: DataFrame, dims: Sequence[str], *extra: str) -> DataFrame:
    rows = changes if cells is None else changes.unionByName(cells.select(*changes.columns))
    return rows.groupBy(*dims, *extra).agg(F.sum("n").cast("bigint").alias("n")).where("n <> 0")


def churn(gaps: DataFrame, days: int, asof: date | None) -> DataFrame:
    """:func:`dealscope.operators.churn.churn` from gaps; without a reference date there is nothing to count."""
    last = F.lit(asof).cast("date")
    edge = F.date_sub(last, days)
    inside = (F.col("day") > F.date_sub(last, 2 * days)) & (F.col("day") <= edge)

    def ending_after(end: Column) -> Column:
        beyond = F.col("next_day").isNull() | (F.col("next_day") > end)
        return F.coalesce(F.sum(F.when(beyond, F.col("n"))), F.lit(0)).cast("bigint")

    counted = gaps.where(inside).agg(ending_after(edge).alias("active_prev"), ending_after(last).alias("churned"))
    rate = F.try_divide(F.col("churned").cast("double"), F.col("active_prev").cast("double"))
    return counted.select("active_prev", "churned", rate.alias("churn_rate"))


def activity_status(sums: DataFrame, days_of: DataFrame, days: int, asof: date | None) -> DataFrame:
    """:func:`dealscope.operators.churn.activity_status` from totals, and from the days of the previous window alone.
    No deal is later than ``asof``."""
    last = F.lit(asof).cast("date")
    edge, start = F.date_sub(last, days), F.date_sub(last, 2 * days)
    before = days_of.where((F.col("deal_date") > start) & (F.col("deal_date") <= edge)).select(
        "agent_id", F.lit(True).alias("prev")).distinct()
    seen = sums.where(F.col("agent_id").isNotNull() & F.col("latest").isNotNull())
    rows = seen.join(before, "agent_id", "left")
    prev, curr = F.coalesce("prev", F.lit(False)), F.col("latest") > edge
    status = (F.when(curr & prev, "retained").when(curr & (F.col("first") > edge), "new").when(curr, "reactivated")
              .when(prev, "churned").otherwise("dormant"))
    return rows.select("agent_id", status.alias("status"))


def rf_segment(sums: DataFrame, asof: date | None, key: str = "agent_id") -> DataFrame:
    """:func:`dealscope.operators.rf.rf_segment` from totals."""
    seen = sums.where(F.col(key).isNotNull() & F.col("latest").isNotNull())
    return rf.binned(seen.select(key, _recency(asof), "frequency"))


def rf_matrix(cells: DataFrame, asof: date | None) -> DataFrame:
    """:func:`dealscope.operators.rf.rf_matrix` from cells."""
    return rf.grid(rf.binned(cells.select(_recency(asof), "frequency", "n")).select("r_bin", "f_bin", "n"))


def _recency(asof: date | None) -> Column:
    return F.datediff(F.lit(asof).cast("date"), F.col("latest")).cast("bigint").alias("recency_days")


def cohort_size(cells: DataFrame) -> DataFrame:
    return cells.where("k = 0 OR cohort IS NULL").select("cohort", F.col("n").alias("size"))


def cohort_retention(cells: DataFrame) -> DataFrame:
    return cohort.retention(cells.where("cohort IS NOT NULL").select("cohort", "k", F.col("n").alias("active")))
