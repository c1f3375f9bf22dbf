"""What the plans must not do at scale, and what they must push down."""

from datetime import date, datetime

import pytest

from dealscope.operators import churn, facts
from dealscope.operators.versions import incremental
from dealscope.plans import views
from dealscope.plans.catalog import QUERIES

BATCH = sorted(name for name in QUERIES if not name.startswith("refreshed_") and name not in (
    "raw_incremental_latest", "funnel_daily_stream", "funnel_daily_late"))


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_pairing_and_no_python(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas", "Arrow"):
        assert bad not in plan, plan


@pytest.mark.parametrize("name", sorted(n for n in BATCH if n.startswith(("funnel", "agent_stage"))))
def test_stage_filter_and_columns_reach_the_scan(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert plan.count("PushedFilters: [In(event_type") == 1
    assert "props" not in plan and "event_id" not in plan


def test_won_filter_reaches_the_scan_and_top_is_taken_per_task(spark, sf_dir):
    plan = plan_of(QUERIES["leaderboard_agent"](spark, sf_dir))
    assert "EqualTo(o_orderstatus,F)" in plan and "TakeOrderedAndProject" in plan
    assert "o_orderpriority" not in plan


def test_window_dates_reach_the_scan_of_condensed_facts(spark, sf_dir, tmp_path):
    """Condensed facts hold a date column, so the windows prune files and row groups."""
    path = f"file://{tmp_path}/facts"
    facts.roll_up_deals(views.deal_facts(spark, sf_dir)).write.parquet(path)
    plan = plan_of(churn.churn(spark.read.parquet(path), 180, date(2001, 8, 1)))
    assert "GreaterThan(deal_date," in plan and "LessThanOrEqual(deal_date,2001-08-01)" in plan


def test_default_window_reaches_the_scan_of_condensed_facts(spark, sf_dir, tmp_path):
    path = f"file://{tmp_path}/facts"
    facts.roll_up_deals(views.deal_facts(spark, sf_dir)).write.parquet(path)
    plan = plan_of(churn.churn(spark.read.parquet(path), 180))
    assert "GreaterThan(deal_date,2" in plan or "GreaterThan(deal_date,1" in plan, plan


def test_second_load_reads_from_the_cursor_on(spark, sf_dir):
    rows = views.deal_versions(views.table(spark, sf_dir, "orders"))
    plan = plan_of(incremental(rows, "updated_at", datetime(2001, 1, 1)))
    assert "GreaterThanOrEqual(o_orderdate,2001-01-01" in plan, plan


@pytest.mark.parametrize("name", ["rating_agent", "rating_agent_in_agency", "rating_agency"])
def test_deals_are_scanned_once_for_ranks(spark, sf_dir, name):
    """Counting for the ranks reuses the shuffle of the totals; the filter on won deals is pushed."""
    frame = QUERIES[name](spark, sf_dir)
    frame.collect()
    final = plan_of(frame).split("== Initial Plan ==")[0]
    scans = [line for line in final.splitlines() if "FileScan" in line and "o_custkey" in line]
    assert len(scans) == 1 and "EqualTo(o_orderstatus,F)" in scans[0], final


@pytest.mark.parametrize("name", ["churn_agent", "activity_status", "rf_segment", "cohort_size", "agent_day"])
def test_aggregates_combine_before_their_shuffle(spark, sf_dir, name):
    lines = plan_of(QUERIES[name](spark, sf_dir)).splitlines()
    below = [lines[n + 1] for n, line in enumerate(lines) if "Exchange hashpartitioning(agent_id" in line]
    assert below and all("HashAggregate" in line for line in below)


def test_staging_names_a_parsed_key_once(spark, sf_dir):
    """The filter on the key stays above the parsers; copied into it they would run once more for each cell they name."""
    plan = plan_of(QUERIES["staging_market"](spark, sf_dir))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("concat_ws" not in line for line in scans), scans
    assert len(plan) < 60_000, len(plan)
