"""Additive facts that every mart is computed from.

``deal_facts`` and ``stage_marks`` only project, so a mart built straight on
them is one scan and its own aggregations. ``roll_up_deals`` and
``roll_up_marks`` condense the same columns to one row per agent and day; since
all measures are sums or bit masks, a mart gives the same result on either
form. A refresh therefore scans the large tables once and feeds every mart from
the condensed ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOLUME = "decimal(38,2)"


def deal_facts(deals: DataFrame, won: str, *extra: str) -> DataFrame:
    """``agent_id, deal_date, deals, won_deals, volume``; volume is that of won deals."""
    is_won = F.col("status") == won
    return deals.select(
        *extra,
        "agent_id",
        "deal_date",
        F.lit(1).cast("bigint").alias("deals"),
        F.when(is_won, 1).otherwise(0).cast("bigint").alias("won_deals"),
        F.when(is_won, F.coalesce("amount", F.lit(0))).otherwise(0).cast("decimal(18,2)").alias("volume"),
    )


def roll_up_deals(facts: DataFrame, *extra: str) -> DataFrame:
    return facts.groupBy(*extra, "agent_id", "deal_date").agg(
        F.sum("deals").alias("deals"),
        F.sum("won_deals").alias("won_deals"),
        F.sum("volume").cast(VOLUME).alias("volume"),
    )


def stage_number(code: Column, stages: Sequence[str]) -> Column:
    """1-based place of a stage code in ``stages``; NULL for other codes."""
    return _by_stage(code, stages, range(1, len(stages) + 1))


def stage_mark(code: Column, stages: Sequence[str]) -> Column:
    """The bit of a stage code in a mask."""
    return _by_stage(code, stages, [1 << place for place in range(len(stages))])


def _by_stage(code: Column, stages: Sequence[str], values: Iterable[int]) -> Column:
    """The value given for each stage. The list is configuration, so it becomes
    part of the expression and needs no join."""
    chosen = F.lit(None).cast("int")
    for stage, value in zip(stages, values, strict=True):
        chosen = F.when(code == stage, value).otherwise(chosen)
    return chosen


def stage_marks(events: DataFrame, stages: Sequence[str]) -> DataFrame:
    """``agent_id, day, mask``: bit ``n-1`` of the mask stands for stage ``n``."""
    kept = events.where(F.col("stage_code").isin(list(stages)) & F.col("ts").isNotNull())
    return kept.select(
        "agent_id",
        F.col("ts").cast("date").alias("day"),
        stage_mark(F.col("stage_code"), stages).alias("mask"),
    )


def roll_up_marks(marks: DataFrame, *extra: str) -> DataFrame:
    return marks.groupBy(*extra, "agent_id", "day").agg(F.bit_or("mask").alias("mask"))


def as_of(facts: DataFrame, given: date | None) -> Column:
    """The reference date of a report: the given one, or the last deal date.

    The default is a scalar subquery over one column, evaluated once per query
    and usable in filters, rather than a join.
    """
    if given is not None:
        return F.lit(given)
    return facts.agg(F.max("deal_date")).scalar()


def last_day(facts: DataFrame) -> date | None:
    """The last deal date, read at once: as a literal it prunes files and row groups, as a subquery it doesn't."""
    return facts.agg(F.max("deal_date")).first()[0]


def attribute(per_agent: DataFrame, agents: DataFrame) -> DataFrame:
    """Add ``agency_id`` to rows already reduced to a few per agent.

    Reducing first means a huge agency brings one row per agent to the join. No
    broadcast is forced, because the agent dimension grows with the data: AQE
    broadcasts it when it is measured to be small.
    """
    return per_agent.join(agents.select("agent_id", "agency_id"), "agent_id", "left")
