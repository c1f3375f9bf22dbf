"""What marts are computed from between cycles, and how a cycle patches it.

A cycle compares the fact blocks that it rewrote with what they were, and patches
the states of the agents and agencies these differences name. Blocks of other
agents aren't read. The marts then read totals (a row per seller), cells (as many
as the calendar allows) or, for activity, the days of one window, never the facts.

=========================  =========================================================  =====================
state                      rows                                                       blocks
=========================  =========================================================  =====================
``state/agent_day``        deals, won deals and volume of an agent and day            ranges of agent ids
``state/agent_total``      first and last day and sums of an agent                    the same
``state/agent_units``      an agent's funnel units by stages touched and reached      the same
``state/agency_day`` ...   the same of agencies, by the agency that agents have now   hashes of agency ids
``cells/...``              counts of agents, agencies and units                       whole
=========================  =========================================================  =====================
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealscope.operators import differences as diff
from dealscope.operators import funnel, rating
from dealscope.operators.facts import VOLUME, attribute, last_day
from dealscope.session import remove
from dealscope.sources import warehouse
from dealscope.sources.warehouse import EMPTY, WHOLE, Tables

NO_KEY = "none"
_DAY = f"deal_date date, deals bigint, won_deals bigint, volume {VOLUME}"
_TOTAL = f"first date, latest date, frequency bigint, deals bigint, volume {VOLUME}"
#: Columns of the states.
SCHEMAS = {
    "cells/days": "deal_date date, n bigint", "cells/units": "period date, mask bigint, stage bigint, n bigint",
    "cells/agent_gap": "day date, next_day date, n bigint", "cells/agency_gap": "day date, next_day date, n bigint",
    "cells/agent_rf": "latest date, frequency bigint, n bigint", "cells/agent_cohort": "cohort date, k bigint, n bigint",
    "state/agent_day": f"agent_id bigint, {_DAY}", "state/agency_day": f"agency_id string, {_DAY}",
    "state/agent_total": f"agent_id bigint, {_TOTAL}", "state/agency_total": f"agency_id string, {_TOTAL}",
    "state/agent_units": "agent_id bigint, mask bigint, stage bigint, n bigint",
    "state/agency_units": "agency_id string, mask bigint, stage bigint, n bigint",
}
#: Of a staging table only what attribution reads.
STAGED = {"staging/agent": "agent_id bigint, agency_id string"}


def agent_block(ids: int) -> Column:
    return F.coalesce(F.floor(F.col("agent_id") / ids).cast("bigint").cast("string"), F.lit(NO_KEY))


def agency_block(blocks: int) -> Column:
    return F.when(F.col("agency_id").isNull(), NO_KEY).otherwise(F.pmod(F.xxhash64("agency_id"), F.lit(blocks)).cast("string"))


class Cycle:
    """The tables as they were before a cycle, and as it has left them so far."""

    def __init__(self, spark: SparkSession, root: str, batch_id: int, before: Tables, now: Tables, settings):
        self.spark, self.root, self.batch_id, self.settings = spark, root, batch_id, settings
        self.before, self.now = before, now
        self.changed: Tables = {}
        self.passing: list[str] = []

    def old(self, table: str, blocks: Sequence[str] | None = None) -> DataFrame | None:
        return warehouse.read_table(self.spark, self.root, table, blocks, self.before, {**SCHEMAS, **STAGED}.get(table))

    def new(self, table: str, blocks: Sequence[str] | None = None) -> DataFrame | None:
        return warehouse.read_table(self.spark, self.root, table, blocks, self._tables(), {**SCHEMAS, **STAGED}.get(table))

    def all_of(self, table: str) -> DataFrame | None:
        """A state, without rows if all its blocks are empty; None if there is none yet."""
        rows, schema = self.new(table), {**SCHEMAS, **STAGED}.get(table)
        if rows is None and table in self._tables() and schema:
            return self.spark.createDataFrame([], schema)
        return rows

    def _tables(self) -> Tables:
        return {**self.now, **{t: {**self.now.get(t, {}), **blocks} for t, blocks in self.changed.items()}}

    def batch(self, rows: DataFrame, table: str) -> DataFrame:
        """Differences of this cycle, written once for their several readers."""
        warehouse.write_snapshot(rows, self.root, table, self.batch_id)
        self.passing.append(f"{self.root}/{table}/batch_id={self.batch_id}")
        return self.spark.read.schema(rows.schema).parquet(self.passing[-1])

    def keep(self, rows: DataFrame, table: str, block: Column, touched: Sequence[str]) -> None:
        """Rewrite the touched blocks of a state."""
        rows = rows.withColumn("block", block).hint("rebalance", "block")
        warehouse.write_snapshot(rows, self.root, table, self.batch_id, block="block")
        written = warehouse.written_blocks(self.spark, self.root, table, self.batch_id)
        self.changed[table] = {**dict.fromkeys(touched, EMPTY), **dict.fromkeys(written, self.batch_id)}

    def whole(self, rows: DataFrame, table: str) -> None:
        warehouse.write_snapshot(rows, self.root, table, self.batch_id)
        self.changed[table] = {WHOLE: self.batch_id}

    def patch_cells(self, changes: DataFrame, table: str, dims: Sequence[str]) -> None:
        self.whole(diff.patched_cells(self.old(table), changes, dims), table)

    def agents_of(self, blocks: Sequence[str], read: Callable) -> DataFrame | None:
        """The rows of staged agents that the given blocks of agent states stand for."""
        ids, wide = self.settings.agent_block, self.settings.block_ids
        staged = {n for b in blocks if b != NO_KEY for n in range(int(b) * ids // wide, ((int(b) + 1) * ids - 1) // wide + 1)}
        return read("staging/agent", [str(n) for n in sorted(staged)]) if staged else None


def _blocks(rows: DataFrame | None) -> list[str]:
    """Their names; there are as many as blocks are touched."""
    return [] if rows is None else sorted(r[0] for r in rows.select("block").distinct().collect())


def _of(rows: DataFrame | None, keys: DataFrame, key: str) -> DataFrame | None:
    """The rows of some keys, null among them."""
    if rows is None:
        return None
    wanted = keys.select(F.col(key).alias("_key"))
    return rows.join(wanted, F.col(key).eqNullSafe(F.col("_key")), "left_semi")


def _placed(rows: DataFrame | None, agents: DataFrame | None) -> DataFrame | None:
    if rows is None:
        return None
    return rows.withColumn("agency_id", F.lit(None).cast("string")) if agents is None else attribute(rows, agents)


def load_states(spark: SparkSession, root: str, batch_id: int, before: Tables, changed: Tables, now: Tables,
                settings) -> Tables:
    """Patch the states with what the cycle changed in facts and in the agencies of agents."""
    cycle = Cycle(spark, root, batch_id, before, now, settings)
    moved = _moved(cycle, list(changed["staging/agent"])) if "staging/agent" in changed else None
    parts = [(_patch_days, _fact_blocks(cycle, "fact/agent_day", "state/agent_day", changed)),
             (_patch_units, _fact_blocks(cycle, "fact/agent_stage_day", "state/agent_units", changed))]
    with ThreadPoolExecutor(len(parts)) as pool:
        for done in [pool.submit(patch, cycle, facts, moved) for patch, facts in parts]:
            done.result()
    for folder in cycle.passing:
        remove(spark, folder)
    return cycle.changed


def _fact_blocks(cycle: Cycle, facts: str, state: str, changed: Tables) -> list[str]:
    """Fact blocks to compare; all of them where a warehouse has facts but no states yet."""
    if state not in cycle.before:
        return list(cycle.now.get(facts, {}))
    return list(changed.get(facts, {}))


def _moved(cycle: Cycle, blocks: list[str]) -> DataFrame | None:
    """``agent_id, block`` of the agents whose agency isn't what it was."""
    rows = diff.signed(*[r if r is None else r.select("agent_id", "agency_id") for r in (
        cycle.old("staging/agent", blocks), cycle.new("staging/agent", blocks))])
    if rows is None:
        return None
    other = rows.where("agency_id IS NOT NULL").groupBy("agent_id", "agency_id").agg(F.sum("w").alias("w")).where("w <> 0")
    return cycle.batch(other.select("agent_id").distinct().withColumn("block", agent_block(cycle.settings.agent_block)), "diff/moved")


def _touched(changes: DataFrame | None, moved: DataFrame | None) -> DataFrame | None:
    parts = [r.select("agent_id", "block") for r in (changes, moved) if r is not None]
    if not parts:
        return None
    return (parts[0] if len(parts) == 1 else parts[0].union(parts[1])).distinct()


def _patch_days(cycle: Cycle, facts: list[str], moved: DataFrame | None) -> None:
    s, by = cycle.settings, agent_block(cycle.settings.agent_block)
    changes = None
    if facts:
        old = cycle.old("fact/agent_day", facts) if "state/agent_day" in cycle.before else None
        changes = diff.day_changes(old, cycle.new("fact/agent_day", facts), "agent_id")
    if changes is not None:
        changes = cycle.batch(changes.withColumn("block", by), "diff/agent_day")
        # Days with any deals, whoever made them: the last one is the reference date of the reports.
        cycle.patch_cells(diff.cell_changes(changes.where("deal_date IS NOT NULL"), ["deal_date"], "deals"),
                          "cells/days", ["deal_date"])
        both = _patch_seller(cycle, changes, "agent", by)
        if both is not None:
            cycle.patch_cells(diff.cell_changes(diff.rf_cells(both, "agent_id", "w"), ["latest", "frequency"]),
                              "cells/agent_rf", ["latest", "frequency"])
            cycle.patch_cells(diff.cell_changes(diff.cohort_cells(both, "agent_id", s.grain, "w"), ["cohort", "k"]),
                              "cells/agent_cohort", ["cohort", "k"])
    sides = _sides(cycle, "state/agent_day", changes, moved)
    if sides is None:
        return
    by = agency_block(s.text_blocks)
    changes = diff.day_changes(*sides, "agency_id")
    if changes is not None:
        _patch_seller(cycle, cycle.batch(changes.withColumn("block", by), "diff/agency_day"), "agency", by)


def _sides(cycle: Cycle, state: str, changes: DataFrame | None, moved: DataFrame | None
           ) -> tuple[DataFrame | None, DataFrame | None] | None:
    """A state's rows of touched agents, before with the agencies they had and now with those they have."""
    touched = _touched(changes, moved)
    blocks = _blocks(touched)
    if not blocks:
        return None
    return tuple(_placed(_of(read(state, blocks), touched, "agent_id"), cycle.agents_of(blocks, read))
                 for read in (cycle.old, cycle.new))


def _patch_seller(cycle: Cycle, changes: DataFrame, kind: str, by: Column) -> DataFrame | None:
    """Patch days, totals and gaps of agents or agencies; returns the days of those that changed, signed."""
    key, days, blocks = f"{kind}_id", f"state/{kind}_day", _blocks(changes)
    if not blocks:
        return None
    cycle.keep(diff.patched_days(cycle.old(days, blocks), changes, key), days, by, blocks)
    now = cycle.new(days, blocks)
    empty = cycle.spark.createDataFrame([], SCHEMAS[days])
    cycle.keep(diff.totals(empty if now is None else now, key), f"state/{kind}_total", by, blocks)
    keys = changes.select(key).distinct()
    both = diff.signed(_of(cycle.old(days, blocks), keys, key), _of(empty if now is None else now, keys, key))
    cycle.patch_cells(diff.cell_changes(diff.gap_cells(both, key, "w"), ["day", "next_day"]),
                      f"cells/{kind}_gap", ["day", "next_day"])
    return both


def _period_of(day: str, period: str | None) -> str:
    """The period that a block of events belongs to."""
    if period is None or day == "undated":
        return ""
    given = date.fromisoformat(day)
    starts = {"week": given - timedelta(given.weekday()), "month": given.replace(day=1),
              "quarter": given.replace(month=(given.month - 1) // 3 * 3 + 1, day=1), "year": given.replace(month=1, day=1)}
    return starts[period].isoformat()


def _patch_units(cycle: Cycle, facts: list[str], moved: DataFrame | None) -> None:
    s, table = cycle.settings, "fact/agent_stage_day"
    changes = None
    if facts:
        # A unit is judged by all days of its period.
        periods = {_period_of(day, s.period) for day in facts}
        days = sorted({d for tables in (cycle.before, cycle.now) for d in tables.get(table, {})
                       if _period_of(d, s.period) in periods})
        old = cycle.old(table, days) if "state/agent_units" in cycle.before else None
        units = diff.signed(*[r if r is None else funnel.unit_states(r, s.period) for r in (old, cycle.new(table, days))])
        if units is not None:
            changes = units.groupBy("agent_id", "period", "mask", "stage").agg(F.sum("w").alias("n")).where("n <> 0")
            changes = cycle.batch(changes.withColumn("block", agent_block(s.agent_block)), "diff/units")
    if changes is not None:
        cycle.patch_cells(diff.cell_changes(changes, ["period", "mask", "stage"], "n"), "cells/units",
                          ["period", "mask", "stage"])
        blocks = _blocks(changes)
        if blocks:
            own = diff.cell_changes(changes, ["agent_id", "mask", "stage"], "n")
            cycle.keep(diff.patched_cells(cycle.old("state/agent_units", blocks), own, ["agent_id", "mask", "stage"]),
                       "state/agent_units", agent_block(s.agent_block), blocks)
    sides = _sides(cycle, "state/agent_units", changes, moved)
    rows = diff.signed(*sides) if sides else None
    if rows is not None:
        by = agency_block(s.text_blocks)
        own = diff.cell_changes(rows, ["agency_id", "mask", "stage"], count=F.col("n"))
        own = cycle.batch(own.withColumn("block", by), "diff/agency_units")
        blocks = _blocks(own)
        if blocks:
            cycle.keep(diff.patched_cells(cycle.old("state/agency_units", blocks), own.drop("block"),
                                          ["agency_id", "mask", "stage"]), "state/agency_units", by, blocks)


def sellers(sums: DataFrame, key: str) -> DataFrame:
    """Those with won deals, as :func:`dealscope.operators.rating.sales` has them."""
    return sums.where("deals > 0").select(key, "deals", "volume")


def marts(s) -> dict[str, tuple[Sequence[str], Callable[..., DataFrame]]]:
    """Each mart with the states it is computed from."""
    n, staged = len(s.stages), "staging/agent"
    total, agency = "state/agent_total", "state/agency_total"
    return {
        "funnel_reached": (["cells/units"], lambda c: funnel.counted_units(c, n, "reached")),
        "funnel_snapshot": (["cells/units"], lambda c: funnel.counted_units(c, n, "snapshot")),
        "funnel_ordered": (["cells/units"], lambda c: funnel.counted_units(c, n, "ordered")),
        "funnel_by_agency": (["state/agency_units", staged], lambda c, _: funnel.counted_units(c, n, "snapshot", ["agency_id"])),
        "funnel_by_period": (["cells/units"], lambda c: funnel.counted_units(c, n, "snapshot", ["period"])),
        "rating_agent": ([total], lambda t: rating.rated(sellers(t, "agent_id"))),
        "rating_agency": ([agency, staged], lambda t, _: rating.rated(sellers(t, "agency_id"))),
        "rating_agent_in_agency": ([total, staged], lambda t, a: rating.rated_within(sellers(t, "agent_id"), a)),
        "leaderboard_agent": ([total], lambda t: rating.best(sellers(t, "agent_id"), s.top, "agent_id")),
        "leaderboard_agency": ([agency, staged], lambda t, _: rating.best(sellers(t, "agency_id"), s.top, "agency_id")),
        "churn_agent": (["cells/agent_gap", "cells/days"], lambda c, d: diff.churn(c, s.agent_days, last_day(d))),
        "churn_agency": (["cells/agency_gap", "cells/days", staged], lambda c, d, _: diff.churn(c, s.agency_days, last_day(d))),
        "activity_status": ([total, "state/agent_day", "cells/days"], lambda t, days, d: diff.activity_status(
            t, days, s.agent_days, last_day(d))),
        "rf_segment": ([total, "cells/days"], lambda t, d: diff.rf_segment(t, last_day(d))),
        "rf_matrix": (["cells/agent_rf", "cells/days"], lambda c, d: diff.rf_matrix(c, last_day(d))),
        "cohort_size": (["cells/agent_cohort"], diff.cohort_size),
        "cohort_retention": (["cells/agent_cohort"], diff.cohort_retention),
    }


def load_marts(spark: SparkSession, root: str, batch_id: int, before: Tables, changed: Tables, now: Tables,
               settings) -> list[Callable[[], Tables]]:
    """A job for each mart that depends on a changed state."""
    cycle = Cycle(spark, root, batch_id, before, now, settings)
    plan = {name: needs for name, needs in marts(settings).items() if any(t in changed for t in needs[0])}
    rows = {t: cycle.all_of(t) for needs, _ in plan.values() for t in needs}

    def write(name: str, needs: Sequence[str], build: Callable[..., DataFrame]) -> Tables:
        warehouse.write_snapshot(build(*[rows[t] for t in needs]), root, f"mart/{name}", batch_id)
        return {f"mart/{name}": {WHOLE: batch_id}}

    return [lambda job=(name, *needs): write(*job) for name, needs in plan.items()
            if all(rows[t] is not None for t in needs[0])]
