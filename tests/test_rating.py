"""Ranks, ratings and leaderboards, with ties and crowded groups."""

import random
from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from dealscope.operators import facts, rating
from dealscope.operators.ranking import ranked

DAY = date(2024, 1, 1)


def deal_frame(spark, rows):
    frame = spark.createDataFrame(rows, "agent_id long, amount string, status string, deal_date date")
    return frame.withColumn("amount", F.col("amount").cast("decimal(18,2)"))


def agents_of(spark, pairs):
    return spark.createDataFrame(pairs, "agent_id long, agency_id string")


def test_ranked_against_brute_force(spark):
    """Keys far apart and close together, negative ones, a third of all rows tied."""
    pick = random.Random(3)
    keys = [0] * 700 + [pick.choice((1, -1)) * pick.randrange(1 << pick.choice((3, 20, 22, 41, 59)))
                        for _ in range(1300)]
    groups = ["big" if pick.random() < 0.5 else f"g{pick.randrange(5)}" for _ in keys]
    rows = spark.createDataFrame(list(zip(range(len(keys)), keys, groups)), "id long, v long, g string")

    got = {r.id: r.rnk for r in ranked(rows, F.col("v")).collect()}
    assert got == {i: 1 + sum(k < key for k in keys) for i, key in enumerate(keys)}

    inside = {r.id: r.rnk for r in ranked(rows, F.col("v"), ["g"]).collect()}
    assert inside == {i: 1 + sum(k < key for k, h in zip(keys, groups) if h == groups[i])
                      for i, key in enumerate(keys)}


def test_huge_and_missing_keys(spark):
    """Keys beyond 64 bits, neighbours among them, and rows without a key come last."""
    keys = [Decimal(10) ** 20, Decimal(10) ** 20 + Decimal("0.01"), -Decimal(10) ** 30, Decimal(10) ** 35, None, None]
    rows = spark.createDataFrame([(n, None if k is None else str(k)) for n, k in enumerate(keys)], "id long, v string")
    got = {r.id: r.rnk for r in ranked(rows, F.col("v").cast("decimal(38,2)")).collect()}
    assert got == {2: 1, 0: 2, 1: 3, 3: 4, 4: 5, 5: 5}


def test_leaderboards_name_sellers(spark):
    """Volume without an agency is rated, but takes no place."""
    deals = deal_frame(spark, [(1, "90.00", "F", DAY), (2, "10.00", "F", DAY), (None, "99.00", "F", DAY)])
    agents, deal_facts = agents_of(spark, [(2, "y")]), facts.deal_facts(deals, "F")
    assert {r.agency_id: r.rnk for r in rating.rating(deal_facts, agents).collect()} == {None: 1, "y": 2}
    assert [(r.place, r.agency_id) for r in rating.leaderboard(deal_facts, 3, agents).collect()] == [(1, "y")]
    assert [(r.place, r.agent_id) for r in rating.leaderboard(deal_facts, 1).collect()] == [(1, 1)]


def test_ties_share_a_rank_and_ids_break_the_leaderboard(spark):
    deals = deal_frame(spark, [(1, "10.00", "F", DAY), (2, "10.00", "F", DAY), (3, "5.01", "F", DAY),
                               (3, "4.98", "F", DAY), (4, "99.00", "O", DAY), (5, None, "F", DAY)])
    deal_facts = facts.deal_facts(deals, "F")
    got = {r.agent_id: (r.deals, r.volume, r.rnk) for r in rating.rating(deal_facts).collect()}
    assert got == {1: (1, Decimal("10.00"), 1), 2: (1, Decimal("10.00"), 1), 3: (2, Decimal("9.99"), 3),
                   5: (1, Decimal("0.00"), 4)}
    top = rating.leaderboard(deal_facts, 2).orderBy("place").collect()
    assert [(r.place, r.agent_id) for r in top] == [(1, 1), (2, 2)]


def test_agency_sums_cover_agents_without_an_agency(spark):
    pick = random.Random(5)
    rows = [(pick.randrange(30), f"{pick.randrange(10000) / 100:.2f}", pick.choice("FO"), DAY) for _ in range(600)]
    rows += [(7, "1.00", "F", DAY)] * 300
    agents = agents_of(spark, [(a, f"y{a % 4}") for a in range(25)])
    deal_facts = facts.deal_facts(deal_frame(spark, rows), "F")
    by_agent, by_agency = rating.rating(deal_facts).collect(), rating.rating(deal_facts, agents).collect()
    assert sum(r.volume for r in by_agent) == sum(r.volume for r in by_agency)
    assert sum(r.deals for r in by_agent) == sum(r.deals for r in by_agency)
    assert {r.agency_id for r in by_agency} == {"y0", "y1", "y2", "y3", None}
    assert sorted(r.rnk for r in by_agency) == [1, 2, 3, 4, 5]

    inside = rating.rating_within(deal_facts, agents).collect()
    for agency in {r.agency_id for r in inside}:
        members = [r for r in inside if r.agency_id == agency]
        for r in members:
            assert r.rnk == 1 + sum(m.volume > r.volume for m in members)


def test_rolled_up_facts_and_period(spark):
    rows = [(1, "3.00", "F", DAY), (1, "3.00", "F", DAY), (1, "4.00", "F", date(2024, 2, 1)), (2, "5.00", "F", DAY)]
    deal_facts = facts.deal_facts(deal_frame(spark, rows), "F")
    rolled = facts.roll_up_deals(deal_facts)
    same = lambda f: sorted(tuple(r) for r in rating.rating(f).collect())
    assert same(deal_facts) == same(rolled)
    january = rating.rating(rolled, period=(DAY, date(2024, 1, 31))).orderBy("rnk").collect()
    assert [(r.agent_id, r.volume) for r in january] == [(1, Decimal("6.00")), (2, Decimal("5.00"))]
