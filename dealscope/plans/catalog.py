"""Named queries over the test tables. Each takes ``(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealscope import schemas
from dealscope.operators import churn, cohort, deletions, facts, funnel, rating, rf, staging, unit_bitmaps, validity
from dealscope.operators.versions import incremental
from dealscope.plans import views
from dealscope.plans.views import RULES, STAGES
from dealscope.session import shared_dir
from dealscope.sources import warehouse
from dealscope.streaming import daily, feeds, refresh

Query = Callable[[SparkSession, str], DataFrame]

N_STAGES = len(STAGES)
AGENT_DAYS = 180
AGENCY_DAYS = 30
TOP = 10
QUANTILES = (0.25, 0.5, 0.75)
TEN_DAYS = (date(2024, 1, 5), date(2024, 1, 14))
#: Deals that a source has lost.
LOST = "deal_id % 97 = 0 OR deal_id BETWEEN 5000 AND 6000"
YEAR = (date(2000, 1, 1), date(2000, 12, 31))


def _funnel(function, by_agency: bool = False, by_period: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        agents = views.agents(spark, sf_dir) if by_agency else None
        return function(views.stage_marks(spark, sf_dir), N_STAGES, "week", agents, by_period)
    return run


def _funnel_ordered(by_agency: bool = False, by_period: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        agents = views.agents(spark, sf_dir) if by_agency else None
        paths = funnel.stage_paths(views.stage_events(spark, sf_dir), STAGES)
        return funnel.funnel_ordered(paths, N_STAGES, "week", agents, by_period)
    return run


def _deals(function, *args, by_agency: bool = False, won_only: bool = False, **options) -> Query:
    """A mart over deal facts; ``won_only`` marts read won deals alone."""
    source = views.won_facts if won_only else views.deal_facts

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        agents = {"agents": views.agents(spark, sf_dir)} if by_agency else {}
        return function(source(spark, sf_dir), *args, **agents, **options)
    return run


def _staging(entity: schemas.Entity, raw: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain_times(views.staged(raw(spark, sf_dir), entity, **RULES[entity.name]))
    return run


def _plain_times(rows: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the test tables store them."""
    return rows.select(*[
        F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
        for name, kind in rows.dtypes
    ])


def staging_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _staging(schemas.EVENT, views.raw_event)(spark, sf_dir)
    props = F.from_json("props", "k bigint")
    return rows.select(
        "event_id", "agent_id", "ts", "stage_code",
        facts.stage_number(F.col("stage_code"), STAGES).cast("bigint").alias("stage_no"),
        props["k"].alias("props_k"))


def staging_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refused cells of deals when statuses other than won and open are unknown."""
    known = {word: code for word, code in views.STATUS_CODES.items() if code != "partial"}
    typed = staging.type_raw(views.raw_deal(spark, sf_dir), schemas.DEAL, codes={"status": known})
    return staging.rejects(typed, schemas.DEAL.key)


def agent_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.roll_up_deals(views.deal_facts(spark, sf_dir))


def agent_stage_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = facts.roll_up_marks(views.stage_marks(spark, sf_dir))
    return rows.withColumn("mask", F.col("mask").cast("bigint"))


def raw_incremental_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deals after two loads on one cursor. At the first the source ends with some day and all amounts of
    that last day are still open; the second reads from that day on, so its deals come in both loads."""
    source = views.deal_versions(views.table(spark, sf_dir, "orders"))
    root = shared_dir(spark, "raw-latest")
    days = source.agg(F.min("updated_at").alias("a"), F.max("updated_at").alias("b")).first()
    middle = days.a + (days.b - days.a) / 2 if days.a else None
    so_far = source.where(F.col("updated_at") <= F.lit(middle).cast("timestamp_ntz"))
    seen = so_far.agg(F.max("updated_at")).first()[0]
    open_still = F.col("updated_at") == F.lit(seen).cast("timestamp_ntz")
    first = so_far.withColumns({
        "amount": F.when(open_still, F.lit(0).cast("decimal(18,2)")).otherwise(F.col("amount")),
        "status": F.when(open_still, "O").otherwise(F.col("status"))})
    loads = [first, incremental(source, "updated_at", seen)]
    for load, rows in enumerate(loads):
        staging.to_raw(rows, "crm", load).write.parquet(f"{root}/raw/load={load}")
    raw = reduce(DataFrame.unionByName, [spark.read.parquet(f"{root}/raw/load={load}") for load in range(2)])
    return _plain_times(views.staged(raw, schemas.DEAL, **RULES["deal"]))


def funnel_daily_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily stage counts of the event stream when every event is delivered twice."""
    root = shared_dir(spark, "funnel-daily")
    once = views.events_of(views.stream(spark, sf_dir, "events"))
    daily.keep_daily(once.unionByName(once), STAGES, root, f"{root}/checkpoint", feeds.AVAILABLE_NOW)
    return warehouse.read_mart(spark, root, "funnel_daily")


def funnel_daily_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily stage counts when the newer half of the time comes first, the older half in a later batch, and then
    the newer half again."""
    root = shared_dir(spark, "funnel-daily-late")
    events = views.stage_events(spark, sf_dir)
    ends = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    middle = F.lit(ends.a + (ends.b - ends.a) / 2 if ends.a else None).cast("timestamp_ntz")
    newer = F.col("ts").cast("timestamp_ntz") >= middle
    for rows in (events.where(newer), events.where(~newer | newer.isNull()), events.where(newer)):
        rows.write.mode("append").parquet(f"{root}/landing")
        stream = feeds.read_feed(spark, f"{root}/landing", rows.schema)
        daily.keep_daily(stream, STAGES, f"{root}/warehouse", f"{root}/checkpoint", feeds.AVAILABLE_NOW)
    return warehouse.read_mart(spark, f"{root}/warehouse", "funnel_daily")


@cache
def _refreshed_root(spark: SparkSession, sf_dir: str) -> str:
    """A warehouse filled by a streamed refresh of the whole tables, once per session."""
    root = shared_dir(spark, "refresh")
    streams = views.feeds(spark, sf_dir)
    refresh.refresh(spark, streams, root, f"{root}/checkpoint", views.SETTINGS, feeds.AVAILABLE_NOW)
    return root


@cache
def _side_root(spark: SparkSession, sf_dir: str) -> str:
    """A warehouse with the entities that no mart reads, refreshed from the whole tables once per session."""
    root = shared_dir(spark, "refresh-side")
    refresh.refresh(spark, views.side_feeds(spark, sf_dir), root, f"{root}/checkpoint", views.SETTINGS,
                    feeds.AVAILABLE_NOW)
    return root


def _refreshed_staging(entity: schemas.Entity) -> Query:
    """A staging table as of the last commit of the refresh."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = warehouse.read_table(spark, _side_root(spark, sf_dir), f"staging/{entity.name}")
        return _plain_times(rows.select(*entity.schema.fieldNames()))
    return run


def refreshed_rating_agency_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings of agencies when two extracts of all agents wait for one refresh; the first has everyone elsewhere."""
    root = shared_dir(spark, "refresh-moved")
    landing = {name: f"{root}/landing/{name}" for name in ("agent", "deal")}
    agents = views.stamped(views.agents(spark, sf_dir))
    refresh.land(agents.withColumn("agency_id", F.lit("elsewhere")), "agent", landing["agent"])
    refresh.land(agents, "agent", landing["agent"])
    deals = views.deal_versions(views.table(spark, sf_dir, "orders"))
    refresh.land(deals, "deal", landing["deal"])
    refresh.refresh(spark, refresh.feed_streams(spark, landing), f"{root}/warehouse", f"{root}/checkpoint",
                    views.SETTINGS, feeds.AVAILABLE_NOW)
    return warehouse.read_mart(spark, f"{root}/warehouse", "rating_agency")


def rating_agency_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agencies by the deals that their agents made while they belonged to them."""
    periods = validity.intervals(views.agency_versions(spark, sf_dir), "agent_id", "agency_id", "since")
    return rating.rating_as_of(views.won_facts(spark, sf_dir), periods)


def funnel_units_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct agents per stage over ten days, from daily bitmaps."""
    bitmaps = unit_bitmaps.daily_bitmaps(views.stage_events(spark, sf_dir), STAGES)
    return unit_bitmaps.distinct_units(bitmaps, *TEN_DAYS)


def funnel_units_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    bitmaps = unit_bitmaps.daily_bitmaps(views.stage_events(spark, sf_dir), STAGES)
    return unit_bitmaps.distinct_units(bitmaps, None, None, F.trunc("day", "month").alias("month"))


def _kept(rows: DataFrame, name: str) -> DataFrame:
    path = shared_dir(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def deleted_deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deals that are no longer in the source, which has lost every 97th and, for a while of keys, all of them."""
    ours = views.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("deal_id"))
    return deletions.deleted_keys(ours, ours.where(f"NOT ({LOST})"), "deal_id", _kept, leaf=64)


def refreshed_without_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings of agents after a refresh with all deals and one with the deletions found then."""
    root = shared_dir(spark, "refresh-deleted")
    landing, source = {"deal": f"{root}/landing/deal"}, views.deal_versions(views.table(spark, sf_dir, "orders"))
    for step in (lambda: refresh.land(source, "deal", landing["deal"]),
                 lambda: refresh.land_deletions(spark, f"{root}/warehouse", "deal", source.where(f"NOT ({LOST})"), landing["deal"])):
        step()
        refresh.refresh(spark, refresh.feed_streams(spark, landing), f"{root}/warehouse", f"{root}/checkpoint",
                        views.SETTINGS, feeds.AVAILABLE_NOW)
    return warehouse.read_mart(spark, f"{root}/warehouse", "rating_agent")


@cache
def _patched_root(spark: SparkSession, sf_dir: str) -> str:
    """A warehouse that was first told wrong agents, days, outcomes and agencies, and half of the events, then the rest
    and what is right in two more cycles, so that its marts are the sums of what was patched."""
    root = shared_dir(spark, "refresh-patched")
    landing = {name: f"{root}/landing/{name}" for name in ("agent", "deal", "event")}
    deals = views.deal_versions(views.table(spark, sf_dir, "orders"))
    agents = views.stamped(views.agents(spark, sf_dir))
    events = views.stage_events(spark, sf_dir)
    wrong = deals.withColumns({
        "agent_id": F.col("agent_id") + 1, "amount": F.lit(1).cast("decimal(18,2)"), "deal_ts": F.expr("deal_ts - INTERVAL 500 DAYS"),
        "status": F.lit("F"), "updated_at": F.lit(views.STAMP).cast("timestamp_ntz") - F.expr("INTERVAL 9000 DAYS")})
    elsewhere = agents.withColumns({"agency_id": F.when(F.col("agent_id") % 5 > 0, "elsewhere"),
                                    "updated_at": F.lit("1999-01-01 00:00:00")})
    even = F.col("deal_id") % 2 == 0
    early = F.col("event_id") % 2 == 0
    for parts in ({"deal": wrong, "agent": elsewhere, "event": events.where(early)},
                  {"deal": deals.where(even), "event": events.where(~early)},
                  {"deal": deals.where(~even), "agent": agents}):
        for name, rows in parts.items():
            refresh.land(rows, name, landing[name])
        refresh.refresh(spark, refresh.feed_streams(spark, landing), f"{root}/warehouse", f"{root}/checkpoint",
                        views.PATCHED, feeds.AVAILABLE_NOW)
    return f"{root}/warehouse"


def _patched(mart: str) -> Query:
    """A mart whose states were patched by the differences of three cycles."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return warehouse.read_mart(spark, _patched_root(spark, sf_dir), mart)
    return run


#: Marts that a patched warehouse is asked for.
PATCHED_MARTS = ("funnel_snapshot", "funnel_ordered", "funnel_by_agency", "funnel_by_period", "rating_agent", "rating_agency",
                 "rating_agent_in_agency", "leaderboard_agency", "churn_agent", "churn_agency", "activity_status",
                 "rf_segment", "rf_matrix", "cohort_size", "cohort_retention")


def _refreshed(mart: str) -> Query:
    """A mart read back from the warehouse after the refresh."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return warehouse.read_mart(spark, _refreshed_root(spark, sf_dir), mart)
    return run


QUERIES: dict[str, Query] = {
    "funnel_reached": _funnel(funnel.funnel_reached),
    "funnel_snapshot": _funnel(funnel.funnel_snapshot),
    "funnel_ordered": _funnel_ordered(),
    "funnel_by_agency": _funnel(funnel.funnel_snapshot, by_agency=True),
    "funnel_by_week": _funnel(funnel.funnel_snapshot, by_period=True),
    "funnel_reached_by_agency": _funnel(funnel.funnel_reached, by_agency=True),
    "funnel_ordered_by_agency": _funnel_ordered(by_agency=True),
    "rating_agent": _deals(rating.rating, won_only=True),
    "rating_agency": _deals(rating.rating, by_agency=True, won_only=True),
    "rating_agent_in_agency": _deals(rating.rating_within, by_agency=True, won_only=True),
    "leaderboard_agent": _deals(rating.leaderboard, TOP, won_only=True),
    "leaderboard_agency": _deals(rating.leaderboard, TOP, by_agency=True, won_only=True),
    "leaderboard_agent_in_year": _deals(rating.leaderboard, TOP, won_only=True, period=YEAR),
    "rating_agency_in_year": _deals(rating.rating, by_agency=True, won_only=True, period=YEAR),
    "churn_agent": _deals(churn.churn, AGENT_DAYS),
    "churn_agent_as_of": _deals(churn.churn, AGENT_DAYS, asof=YEAR[1]),
    "churn_agency": _deals(churn.churn, AGENCY_DAYS, by_agency=True),
    "activity_status": _deals(churn.activity_status, AGENT_DAYS),
    "rf_segment": _deals(rf.rf_segment),
    "rf_matrix": _deals(rf.rf_matrix),
    "rf_matrix_agency": _deals(rf.rf_matrix, by_agency=True),
    "rf_cuts": _deals(rf.rf_cuts, QUANTILES),
    "cohort_size": _deals(cohort.cohort_size),
    "cohort_retention": _deals(cohort.cohort_retention),
    "cohort_retention_quarter": _deals(cohort.cohort_retention, "quarter"),
    "cohort_retention_agency": _deals(cohort.cohort_retention, by_agency=True),
    "agent_day": agent_day,
    "agent_stage_day": agent_stage_day,
    "staging_manager": _staging(schemas.MANAGER, views.raw_manager),
    "staging_company": _staging(schemas.COMPANY, views.raw_company),
    "staging_agent": _staging(schemas.AGENT, views.raw_agent),
    "staging_deal": _staging(schemas.DEAL, views.raw_deal),
    "staging_event": staging_event,
    "staging_market": _staging(schemas.MARKET, views.raw_market),
    "staging_agent_dirty": _staging(schemas.AGENT, views.raw_agent_dirty),
    "staging_deal_dirty": _staging(schemas.DEAL, views.raw_deal_dirty),
    "staging_showing": _staging(schemas.SHOWING, views.raw_showing),
    "staging_support": _staging(schemas.SUPPORT, views.raw_support),
    "staging_rejects": staging_rejects,
    "raw_incremental_latest": raw_incremental_latest,
    "funnel_daily_stream": funnel_daily_stream,
    "funnel_daily_late": funnel_daily_late,
    "refreshed_funnel_snapshot": _refreshed("funnel_snapshot"),
    "refreshed_funnel_by_agency": _refreshed("funnel_by_agency"),
    "refreshed_rating_agent": _refreshed("rating_agent"),
    "refreshed_leaderboard_agent": _refreshed("leaderboard_agent"),
    "refreshed_churn_agent": _refreshed("churn_agent"),
    "refreshed_rf_matrix": _refreshed("rf_matrix"),
    "refreshed_cohort_retention": _refreshed("cohort_retention"),
    "refreshed_rating_agency": _refreshed("rating_agency"),
    "refreshed_funnel_ordered": _refreshed("funnel_ordered"),
    "refreshed_funnel_reached": _refreshed("funnel_reached"),
    "refreshed_funnel_by_period": _refreshed("funnel_by_period"),
    "refreshed_rating_agent_in_agency": _refreshed("rating_agent_in_agency"),
    "refreshed_leaderboard_agency": _refreshed("leaderboard_agency"),
    "refreshed_churn_agency": _refreshed("churn_agency"),
    "refreshed_activity_status": _refreshed("activity_status"),
    "refreshed_rf_segment": _refreshed("rf_segment"),
    "refreshed_cohort_size": _refreshed("cohort_size"),
    "refreshed_rating_agency_moved": refreshed_rating_agency_moved,
    **{f"refreshed_patched_{mart}": _patched(mart) for mart in PATCHED_MARTS},
    "refreshed_without_deleted": refreshed_without_deleted,
    "deleted_deals": deleted_deals,
    "rating_agency_as_of": rating_agency_as_of,
    "funnel_units_in_range": funnel_units_in_range,
    "funnel_units_by_month": funnel_units_by_month,
    "refreshed_company": _refreshed_staging(schemas.COMPANY),
    "refreshed_manager": _refreshed_staging(schemas.MANAGER),
    "refreshed_market": _refreshed_staging(schemas.MARKET),
}
