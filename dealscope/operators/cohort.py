"""Cohorts by the period of the first deal, and how many come back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealscope.operators.facts import attribute

# Months per grain.
GRAINS = {"month": 1, "quarter": 3, "year": 12}


def cohort_size(facts: DataFrame, grain: str = "month", agents: DataFrame | None = None) -> DataFrame:
    """``cohort, size``: how many had their first deal in the period."""
    by = "agent_id"
    first = facts.groupBy(by).agg(F.min("deal_date").alias("first"))
    if agents is not None:
        by = "agency_id"
        first = attribute(first, agents).groupBy(by).agg(F.min("first").alias("first"))
    return (
        first.where(F.col(by).isNotNull())
        .groupBy(F.trunc("first", grain).alias("cohort"))
        .agg(F.count("*").alias("size"))
    )


def cohort_retention(facts: DataFrame, grain: str = "month", agents: DataFrame | None = None) -> DataFrame:
    """``cohort, k, size, active, retention`` for every observed pair.

    ``k`` counts whole periods since the first one. The rows are reduced to the
    distinct periods of each id first, so the window that finds the first period
    works on groups no longer than the calendar. ``size`` is the number active
    at ``k = 0``; the last window runs over one row per cohort and ``k``.
    """
    by = "agent_id"
    active = facts.select(by, F.trunc("deal_date", grain).alias("period")).distinct()
    if agents is not None:
        by = "agency_id"
        active = attribute(active, agents).select(by, "period").distinct()
    cohort = F.min("period").over(Window.partitionBy(by))
    counts = (
        active.where(F.col(by).isNotNull() & F.col("period").isNotNull())
        .select("period", cohort.alias("cohort"))
        .groupBy("cohort", _distance(F.col("cohort"), F.col("period"), grain).alias("k"))
        .agg(F.count("*").alias("active"))
    )
    return retention(counts)


def retention(counts: DataFrame) -> DataFrame:
    """``cohort, k, active`` with the cohort's ``size``, the number active at ``k = 0``, and the share of it."""
    size = F.max(F.when(F.col("k") == 0, F.col("active"))).over(Window.partitionBy("cohort"))
    return counts.select("cohort", "k", size.alias("size"), "active").withColumn(
        "retention", F.col("active").cast("double") / F.col("size").cast("double"))


def _distance(start: Column, end: Column, grain: str) -> Column:
    months = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    return F.floor(months / GRAINS[grain]).cast("bigint")
