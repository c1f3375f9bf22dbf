"""The layers of one refresh: raw, staging, condensed facts, marts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealscope.operators import churn, cohort, facts, funnel, rating, rf, staging
from dealscope.plans import states
from dealscope.schemas import ENTITIES, Entity
from dealscope.sources import warehouse
from dealscope.sources.warehouse import Tables

Codes = dict[str, dict[str, str]]


@dataclass(frozen=True)
class Settings:
    """What a deployment decides; the defaults are our own."""

    stages: tuple[str, ...]
    won: str
    codes: dict[str, Codes] = field(default_factory=dict)
    period: str = "week"
    agent_days: int = 180
    agency_days: int = 30
    top: int = 10
    grain: str = "month"
    # Ids per block of a staging table. A refresh rewrites the blocks it touches.
    block_ids: int = 10_000_000
    # Blocks of a table whose key is text.
    text_blocks: int = 64
    # Ids per block of what is kept for each agent.
    agent_block: int = 1_000_000


JOBS_AT_ONCE = 4

# Columns to fold and to strip to digits, per entity.
NAMES = {"agent": ["agent_name"], "company": ["agency_name"], "manager": ["manager_name"],
         "market": ["object_type"]}
PHONES = {"agent": ["phone"]}


def block_of(entity: Entity, settings: Settings) -> Column:
    """The block a row lives in, decided by its key so that all versions meet.

    Ids grow with time, so a batch of new and recently changed rows touches few
    blocks. Events never change their moment; they are kept by day, so that what
    is condensed per day comes from one block.
    """
    if entity.name == "event":
        return F.coalesce(F.col("ts").cast("date").cast("string"), F.lit("undated"))
    key = F.col(entity.key[0])
    if entity.schema[entity.key[0]].dataType.typeName() == "string":
        return F.pmod(F.xxhash64(key), F.lit(settings.text_blocks)).cast("string")
    return F.floor(key / settings.block_ids).cast("bigint").cast("string")


def tag(rows: dict[str, DataFrame]) -> DataFrame:
    """The rows of several entities as text in one DataFrame, named in ``_entity``."""
    tagged = [
        part.select(F.lit(name).alias("_entity"), *[F.col(c).cast("string").alias(c) for c in part.columns])
        for name, part in rows.items()
    ]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), tagged)


def run_cycle(spark: SparkSession, root: str, source_batch: int, tagged: DataFrame, settings: Settings,
              source: str = "") -> None:
    """Take in one batch of tagged rows and bring every table up to date with it.

    ``source`` names the query whose batch ``source_batch`` this is.

    All tables become visible together. A cycle that fails leaves nothing
    visible and can be run again under the same number; one that is already
    visible is left alone.
    """
    batch_id = warehouse.next_batch(spark, root, source, source_batch)
    if batch_id is None:
        return
    tables = warehouse.committed(spark, root)[1]
    changed: Tables = {}

    def advance(step: Callable[..., Tables], *args) -> None:
        now = {**tables, **{t: {**tables.get(t, {}), **blocks} for t, blocks in changed.items()}}
        changed.update(step(spark, root, batch_id, *args, changed, now, settings))

    entities = load_raw(tagged, root, batch_id)
    advance(load_staging, entities)
    advance(load_condensed)
    advance(partial(_with_states, tables))
    warehouse.publish(spark, root, batch_id, changed, marks_of(spark, root, batch_id, entities),
                      (source, source_batch))


def marks_of(spark: SparkSession, root: str, batch_id: int, entities: Sequence[str]) -> dict[str, str]:
    """How far the batch takes the cursor of each entity that has one."""
    marks = {}
    for entity in (ENTITIES[name] for name in entities if "updated_at" in ENTITIES[name].schema.fieldNames()):
        typed = warehouse.read_batch(spark, root, f"typed/{entity.name}", batch_id)
        mark = typed.agg(F.max("updated_at").cast("string")).first()[0]
        if mark:
            marks[entity.name] = mark
    return marks


def load_raw(tagged: DataFrame, root: str, batch_id: int) -> list[str]:
    """Store a batch in one pass, a folder per entity; returns the entities it has."""
    raw = staging.to_raw(tagged, "feed", batch_id)
    warehouse.write_snapshot(raw, root, "raw", batch_id, block="_entity")
    return warehouse.written_blocks(tagged.sparkSession, root, "raw", batch_id, "_entity")


def load_staging(spark: SparkSession, root: str, batch_id: int, entities: Sequence[str], changed: Tables,
                 now: Tables, settings: Settings) -> Tables:
    """Type the batch of each entity and merge it into the staging tables."""
    return _all_of(
        (lambda e=ENTITIES[name]: merge_entity(spark, root, e, batch_id, now, settings)) for name in entities)


def merge_entity(spark: SparkSession, root: str, entity: Entity, batch_id: int, now: Tables,
                 settings: Settings) -> Tables:
    """Parse a raw batch once, then merge it into the blocks that it touches.

    The typed batch is kept with its refused cells (:func:`rejected`).
    """
    table, typed_table = f"staging/{entity.name}", f"typed/{entity.name}"
    raw = warehouse.read_batch(spark, root, "raw", batch_id).where(F.col("_entity") == entity.name)
    typed = staging.type_raw(raw, entity, NAMES.get(entity.name, ()), PHONES.get(entity.name, ()),
                             settings.codes.get(entity.name))
    warehouse.write_snapshot(typed, root, typed_table, batch_id)

    rows = warehouse.read_batch(spark, root, typed_table, batch_id).drop("_rejects")
    rows = rows.where(F.col(entity.key[0]).isNotNull())
    block = block_of(entity, settings)
    touched = [row.block for row in rows.select(block.alias("block")).distinct().collect()]
    if not touched:
        return {}
    before = warehouse.read_table(spark, root, table, touched, now)
    if before is not None:
        rows = rows.unionByName(before, allowMissingColumns=True)
    rows = staging.settle(rows, entity).withColumn("block", block)
    # Spark splits a crowded block over several tasks, without a pass to sample its keys.
    rows = rows.hint("rebalance", "block")
    warehouse.write_snapshot(rows, root, table, batch_id, block="block")
    # A block whose rows were all deleted has no folder.
    written = warehouse.written_blocks(spark, root, table, batch_id)
    return {table: {**dict.fromkeys(touched, warehouse.EMPTY), **dict.fromkeys(written, batch_id)}}


def rejected(spark: SparkSession, root: str, entity: Entity) -> DataFrame:
    """The refused cells of all visible batches: the key, ``column, cell``."""
    return staging.rejects(warehouse.read_appended(spark, root, f"typed/{entity.name}"), entity.key)


def load_condensed(spark: SparkSession, root: str, batch_id: int, changed: Tables, now: Tables,
                   settings: Settings) -> Tables:
    """Condense the touched blocks of deals and events to rows per agent and day.

    Deals and events are read here and nowhere else; the marts read the result.
    """
    def condense(source: str, table: str, to_facts: Callable[[DataFrame, Settings], DataFrame]) -> Tables:
        rows = warehouse.read_table(spark, root, source, list(changed[source]), now)
        # A block without a single stage event has no folder; what it held before is gone.
        emptied = {b: warehouse.EMPTY for b in changed[source] if b in now.get(table, {})}
        if rows is None:
            return {table: emptied}
        warehouse.write_snapshot(to_facts(rows, settings), root, table, batch_id, block="block")
        return {table: {**emptied, **{b: batch_id for b in warehouse.written_blocks(spark, root, table, batch_id)}}}

    plan = (("staging/deal", "fact/agent_day", _agent_day),
            ("staging/event", "fact/agent_stage_day", _agent_stage_day))
    return _all_of((lambda job=job: condense(*job)) for job in plan if job[0] in changed)


def _agent_day(deals: DataFrame, settings: Settings) -> DataFrame:
    dated = deals.withColumn("deal_date", F.col("deal_ts").cast("date"))
    blocks = dated.withColumn("block", block_of(ENTITIES["deal"], settings))
    return facts.roll_up_deals(facts.deal_facts(blocks, settings.won, "block"), "block")


def _agent_stage_day(events: DataFrame, settings: Settings) -> DataFrame:
    """Stages touched and the path through them, per agent and day, in one pass.
    Events without an agent make up a row like any other, as in the operators."""
    paths = funnel.stage_paths(events, settings.stages, masks=True)
    return paths.withColumn("block", F.col("day").cast("string"))


def _with_states(before: Tables, spark: SparkSession, root: str, batch_id: int, changed: Tables, now: Tables,
                 settings: Settings) -> Tables:
    """Patch the states, then write the marts that depend on a changed one."""
    patched = states.load_states(spark, root, batch_id, before, changed, now, settings)
    now = {**now, **{t: {**now.get(t, {}), **blocks} for t, blocks in patched.items()}}
    jobs = states.load_marts(spark, root, batch_id, before, {**changed, **patched}, now, settings)
    return {**patched, **_all_of(jobs)}


def _all_of(jobs: Iterable[Callable[[], Tables]]) -> Tables:
    """Submit independent writes together, so that one fills the cores that the
    tail of another leaves idle. The first failure ends the cycle."""
    written: Tables = {}
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        for result in pool.map(lambda job: job(), list(jobs)):
            written.update(result)
    return written


def marts(s: Settings) -> dict[str, tuple[Sequence[str], Callable[..., DataFrame]]]:
    """Each mart as one operator over the condensed facts; a cycle gets the same rows from patched states."""
    days, stages, agents = "fact/agent_day", "fact/agent_stage_day", "staging/agent"
    n = len(s.stages)
    return {
        "funnel_reached": ([stages], lambda f: funnel.funnel_reached(f, n, s.period)),
        "funnel_snapshot": ([stages], lambda f: funnel.funnel_snapshot(f, n, s.period)),
        "funnel_ordered": ([stages], lambda f: funnel.funnel_ordered(f, n, s.period)),
        "funnel_by_agency": ([stages, agents], lambda f, a: funnel.funnel_snapshot(f, n, s.period, a)),
        "funnel_by_period": ([stages], lambda f: funnel.funnel_snapshot(f, n, s.period, by_period=True)),
        "rating_agent": ([days], lambda f: rating.rating(f)),
        "rating_agency": ([days, agents], lambda f, a: rating.rating(f, a)),
        "rating_agent_in_agency": ([days, agents], lambda f, a: rating.rating_within(f, a)),
        "leaderboard_agent": ([days], lambda f: rating.leaderboard(f, s.top)),
        "leaderboard_agency": ([days, agents], lambda f, a: rating.leaderboard(f, s.top, a)),
        "churn_agent": ([days], lambda f: churn.churn(f, s.agent_days)),
        "churn_agency": ([days, agents], lambda f, a: churn.churn(f, s.agency_days, agents=a)),
        "activity_status": ([days], lambda f: churn.activity_status(f, s.agent_days)),
        "rf_segment": ([days], lambda f: rf.rf_segment(f)),
        "rf_matrix": ([days], lambda f: rf.rf_matrix(f)),
        "cohort_size": ([days], lambda f: cohort.cohort_size(f, s.grain)),
        "cohort_retention": ([days], lambda f: cohort.cohort_retention(f, s.grain)),
    }
