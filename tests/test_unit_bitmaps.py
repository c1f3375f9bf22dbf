"""A window of days reaches the events that bitmaps are made of, and bitmaps that are stored."""

import re

from dealscope.operators import unit_bitmaps
from dealscope.plans import catalog, views
from tests.test_plans import plan_of


def test_window_reaches_the_events_and_nothing_is_written(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(catalog, "shared_dir", None)
    plan = plan_of(catalog.funnel_units_in_range(spark, sf_dir))
    assert re.search(r"ts#\d+ >= 2024-01-05", plan) and re.search(r"ts#\d+ < 2024-01-15", plan) and "events.parquet" in plan


def test_stored_bitmaps_give_the_same(spark, sf_dir, tmp_path):
    path = f"file://{tmp_path}/bitmaps"
    unit_bitmaps.daily_bitmaps(views.stage_events(spark, sf_dir), catalog.STAGES).write.parquet(path)
    stored = unit_bitmaps.distinct_units(spark.read.parquet(path), *catalog.TEN_DAYS)
    assert "PushedFilters: [IsNotNull(day), GreaterThanOrEqual(day,2024-01-05)" in plan_of(stored)
    assert sorted(stored.collect()) == sorted(catalog.funnel_units_in_range(spark, sf_dir).collect())
