"""Ratings and leaderboards by sales volume."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealscope.operators.facts import VOLUME, attribute
from dealscope.operators.ranking import ranked
from dealscope.operators.validity import valid_at


def sales(facts: DataFrame, agents: DataFrame | None = None,
          period: tuple[date, date] | None = None) -> DataFrame:
    """Won deals and volume per agent, or per agency when ``agents`` is given.

    ``period`` is a first and a last day, both included.
    """
    won = facts.where(F.col("won_deals") > 0)
    if period:
        won = won.where(F.col("deal_date").between(*period))
    per_agent = _totals(won, "agent_id", F.sum("won_deals"), F.sum("volume"))
    if agents is None:
        return per_agent
    return _totals(attribute(per_agent, agents), "agency_id", F.sum("deals"), F.sum("volume"))


def _totals(rows: DataFrame, by: str, deals: Column, volume: Column) -> DataFrame:
    return rows.groupBy(by).agg(deals.cast("bigint").alias("deals"), volume.cast(VOLUME).alias("volume"))


def rating(facts: DataFrame, agents: DataFrame | None = None,
           period: tuple[date, date] | None = None) -> DataFrame:
    """``agent_id|agency_id, deals, volume, rnk``; equal volumes share a rank."""
    return rated(sales(facts, agents, period))


def rated(per_seller: DataFrame) -> DataFrame:
    """``sales`` with ranks."""
    return ranked(per_seller, _by_volume())


def rating_within(facts: DataFrame, agents: DataFrame,
                  period: tuple[date, date] | None = None) -> DataFrame:
    """Rank of each agent inside the agency: ``agency_id, agent_id, deals, volume, rnk``."""
    return rated_within(sales(facts, None, period), agents)


def rated_within(per_agent: DataFrame, agents: DataFrame) -> DataFrame:
    placed = attribute(per_agent, agents)
    return ranked(placed, _by_volume(), within=["agency_id"]).select(
        "agency_id", "agent_id", "deals", "volume", "rnk")


def leaderboard(facts: DataFrame, k: int, agents: DataFrame | None = None,
                period: tuple[date, date] | None = None) -> DataFrame:
    """The ``k`` best by volume, ties broken by id: ``place, id, deals, volume``.

    A leaderboard names sellers, so volume without an id, which ratings show, has no place in it.

    Sort and limit become a per-task top-k, so the window sees ``k`` rows only.
    """
    return best(sales(facts, agents, period), k, "agent_id" if agents is None else "agency_id")


def rating_as_of(facts: DataFrame, periods: DataFrame) -> DataFrame:
    """``agency_id, deals, volume, rnk`` with each deal counted for the agency that its agent belonged to that day.

    ``periods`` are :func:`dealscope.operators.validity.intervals` of agents. Deals are
    summed by agent and day before the join; those without a day, or of agents without
    an agency that day, make up the row without an agency.
    """
    won = facts.where(F.col("won_deals") > 0)
    days = won.groupBy("agent_id", "deal_date").agg(F.sum("won_deals").alias("deals"), F.sum("volume").alias("volume"))
    placed = valid_at(days, periods, "agent_id", "deal_date", ["agency_id"])
    return rated(_totals(placed, "agency_id", F.sum("deals"), F.sum("volume")))


def best(per_seller: DataFrame, k: int, by: str) -> DataFrame:
    order = [F.desc("volume"), F.asc(by)]
    top = per_seller.where(F.col(by).isNotNull()).orderBy(*order).limit(k)
    place = F.row_number().over(Window.orderBy(*order)).cast("bigint")
    return top.select(place.alias("place"), by, "deals", "volume")


def _by_volume() -> Column:
    """Largest volume first."""
    return -F.col("volume")
