"""Who stopped selling: churn over two adjacent windows, and activity statuses."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealscope.operators.facts import as_of, attribute, last_day


def churn(facts: DataFrame, days: int, asof: date | None = None,
          agents: DataFrame | None = None) -> DataFrame:
    """``active_prev, churned, churn_rate`` over agents, or agencies if ``agents`` is given.

    With reference date ``a`` and window ``days``: previous is ``(a-2*days, a-days]``,
    current is ``(a-days, a]``. Churned means active in the previous window and
    not in the current one. The rate is NULL when nobody was active before.
    The default reference date is the last deal's; it is read first, so that the
    window reaches the scan as literals.
    """
    last = F.lit(asof if asof is not None else last_day(facts)).cast("date")
    recent = facts.where((F.col("deal_date") > F.date_sub(last, 2 * days)) & (F.col("deal_date") <= last))
    by = "agent_id"
    in_prev, in_curr = _windows(last, days)
    active = recent.groupBy(by).agg(F.max(in_prev).alias("prev"), F.max(in_curr).alias("curr"))
    if agents is not None:
        by = "agency_id"
        active = attribute(active, agents).groupBy(by).agg(
            F.max("prev").alias("prev"), F.max("curr").alias("curr"))
    counted = active.where(F.col(by).isNotNull()).agg(
        F.count_if(F.col("prev")).alias("active_prev"),
        F.count_if(F.col("prev") & ~F.col("curr")).alias("churned"),
    )
    rate = F.try_divide(F.col("churned").cast("double"), F.col("active_prev").cast("double"))
    return counted.select("active_prev", "churned", rate.alias("churn_rate"))


def activity_status(facts: DataFrame, days: int, asof: date | None = None) -> DataFrame:
    """``agent_id, status``: retained, new, reactivated, churned or dormant."""
    last = as_of(facts, asof)
    in_prev, in_curr = _windows(last, days)
    seen = facts.where((F.col("deal_date") <= last) & F.col("agent_id").isNotNull())
    per_agent = seen.groupBy("agent_id").agg(
        F.min("deal_date").alias("first"), F.max(in_prev).alias("prev"), F.max(in_curr).alias("curr"))
    status = (
        F.when(F.col("curr") & F.col("prev"), "retained")
        .when(F.col("curr") & (F.col("first") > F.date_sub(last, days)), "new")
        .when(F.col("curr"), "reactivated")
        .when(F.col("prev"), "churned")
        .otherwise("dormant")
    )
    return per_agent.select("agent_id", status.alias("status"))


def _windows(last: Column, days: int) -> tuple[Column, Column]:
    """Flags: a deal in the previous window, a deal in the current one."""
    day = F.col("deal_date")
    edge = F.date_sub(last, days)
    return (day > F.date_sub(last, 2 * days)) & (day <= edge), (day > edge) & (day <= last)
