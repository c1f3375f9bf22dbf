"""Churn, activity, RF and cohorts on small histories and at their edges."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from dealscope.operators import churn, cohort, facts, rf

ASOF = date(2024, 6, 30)


def fact_frame(spark, rows):
    deals = spark.createDataFrame(rows, "agent_id long, deal_date date").withColumns(
        {"status": F.lit("F"), "amount": F.lit(1).cast("decimal(18,2)")})
    return facts.deal_facts(deals, "F")


def days_ago(n):
    return ASOF - timedelta(days=n)


def test_window_edges(spark):
    """A deal on asof-W is previous, one on asof-2W is in neither window."""
    f = fact_frame(spark, [(1, days_ago(10)), (2, days_ago(20)), (3, days_ago(19)), (3, days_ago(9)), (4, ASOF)])
    assert tuple(churn.churn(f, 10).first()) == (2, 1, 0.5)
    assert tuple(churn.churn(f, 10, ASOF).first()) == (2, 1, 0.5)


def test_nobody_before_gives_no_rate(spark):
    assert tuple(churn.churn(fact_frame(spark, [(1, ASOF)]), 10).first()) == (0, 0, None)


def test_later_deals_are_ignored(spark):
    f = fact_frame(spark, [(1, days_ago(15)), (1, ASOF + timedelta(3)), (2, ASOF + timedelta(3))])
    assert tuple(churn.churn(f, 10, ASOF).first()) == (1, 1, 1.0)
    assert [tuple(r) for r in churn.activity_status(f, 10, ASOF).collect()] == [(1, "churned")]
    assert [tuple(r) for r in rf.rf_measures(f, ASOF).collect()] == [(1, 15, 1)]


def test_statuses(spark):
    f = fact_frame(spark, [(1, days_ago(15)), (1, ASOF), (2, days_ago(3)), (3, days_ago(50)), (3, days_ago(1)),
                           (4, days_ago(12)), (5, days_ago(99))])
    got = dict(tuple(r) for r in churn.activity_status(f, 10).collect())
    assert got == {1: "retained", 2: "new", 3: "reactivated", 4: "churned", 5: "dormant"}


def test_agency_churn_needs_all_its_agents_gone(spark):
    f = fact_frame(spark, [(1, days_ago(15)), (2, days_ago(2)), (3, days_ago(15)), (9, days_ago(15))])
    agents = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "agent_id long, agency_id string")
    assert tuple(churn.churn(f, 10, ASOF, agents).first()) == (2, 1, 0.5)


def history(seed):
    pick = random.Random(seed)
    rows = [(pick.randrange(60), days_ago(pick.randrange(900))) for _ in range(700)]
    return rows + [(0, days_ago(pick.randrange(900))) for _ in range(400)]


@pytest.mark.parametrize("seed", [1, 2])
def test_rolled_up_equals_direct_and_sums_hold(spark, seed):
    f = fact_frame(spark, history(seed))
    rolled = facts.roll_up_deals(f)
    n = f.select("agent_id").distinct().count()
    for mart in (lambda x: churn.churn(x, 90), lambda x: churn.activity_status(x, 90), rf.rf_segment, rf.rf_matrix,
                 lambda x: rf.rf_cuts(x, [0.1, 0.5]), cohort.cohort_size, cohort.cohort_retention):
        rows = lambda x: sorted(map(str, mart(x).collect()))
        assert rows(f) == rows(rolled)
    assert churn.activity_status(f, 90).count() == n
    matrix = rf.rf_matrix(f).collect()
    assert len(matrix) == 16 and sum(r.n for r in matrix) == n
    assert sum(r.size for r in cohort.cohort_size(f).collect()) == n


@pytest.mark.parametrize("grain", ["month", "quarter", "year"])
def test_retention_against_brute_force(spark, grain):
    rows = history(4)
    months = {"month": 1, "quarter": 3, "year": 12}[grain]
    place = lambda d: (d.year * 12 + d.month - 1) // months
    first, seen = {}, set()
    for agent, day in rows:
        first[agent] = min(first.get(agent, 10**9), place(day))
        seen.add((agent, place(day)))
    want = {}
    for agent, at in seen:
        key = (first[agent], at - first[agent])
        want[key] = want.get(key, 0) + 1
    got = {}
    for r in cohort.cohort_retention(fact_frame(spark, rows), grain).collect():
        assert r.cohort == r.cohort.replace(day=1) and r.retention == r.active / r.size
        got[place(r.cohort), r.k] = r.active
        if r.k == 0:
            assert r.active == r.size and r.retention == 1.0
    assert got == want
    sizes = {place(r.cohort): r.size for r in cohort.cohort_size(fact_frame(spark, rows), grain).collect()}
    assert sizes == {c: n for (c, k), n in want.items() if k == 0}


def test_rf_bins_and_empty_cells(spark):
    f = fact_frame(spark, [(1, ASOF)] * 12 + [(2, days_ago(91))] * 9 + [(3, days_ago(366))])
    got = {r.agent_id: (r.recency_days, r.frequency, r.r_bin, r.f_bin) for r in rf.rf_segment(f).collect()}
    assert got == {1: (0, 12, 1, 1), 2: (91, 9, 2, 2), 3: (366, 1, 4, 4)}
    cells = {(r.r_bin, r.f_bin): r.n for r in rf.rf_matrix(f).collect()}
    assert len(cells) == 16 and {c for c, n in cells.items() if n} == {(1, 1), (2, 2), (4, 4)}
