"""Marts from patched states are what their operators make of all facts."""

import random
from decimal import Decimal
from datetime import datetime, timedelta

import pytest

from dealscope.plans import layers, states
from dealscope.sources import warehouse
from tests.test_refresh import SETTINGS, T0, batches, frame

SMALL = {**{f: getattr(SETTINGS, f) for f in SETTINGS.__dataclass_fields__}, "agent_block": 7, "text_blocks": 3}


def run(spark, root, number, delivery, settings):
    tagged = layers.tag({name: frame(spark, name, rows) for name, rows in delivery.items() if rows})
    layers.run_cycle(spark, root, number, tagged, settings, "test")


def rows_of(frame_):
    return sorted(map(str, frame_.select(*sorted(frame_.columns)).collect()))


def assert_marts(spark, root, settings):
    """Every mart equals its operator on facts made of the staged rows."""
    tables = warehouse.committed(spark, root)[1]
    deals, events = (warehouse.read_table(spark, root, f"staging/{t}", tables=tables) for t in ("deal", "event"))
    source = {"fact/agent_day": layers._agent_day(deals, settings), "fact/agent_stage_day": layers._agent_stage_day(events, settings),
              "staging/agent": warehouse.read_table(spark, root, "staging/agent", tables=tables)}
    for name, (needs, build) in layers.marts(settings).items():
        want = build(*[source[t] for t in needs])
        assert rows_of(warehouse.read_mart(spark, root, name)) == rows_of(want), name


def odd_batches():
    """Deals that change hands, days and outcome or lose their agent or day; agents that move, lose and find an agency;
    events that come for new and old days."""
    dice = random.Random(5)
    day = lambda: str(T0 + timedelta(days=dice.randrange(200), seconds=dice.randrange(86400)))
    out = []
    for turn in range(2):
        stamp = str(T0 + timedelta(days=500 + turn))
        deals = [(str(n), dice.choice([str(dice.randrange(30)), "0", None]), "10,50", dice.choice(["won", "open", "???"]),
                  dice.choice([day(), day(), None]), stamp) for n in dice.sample(range(80), 80 if not turn else 12)]
        agents = [(str(n), "x", dice.choice([None, "y1", "y2", "y3"]), None, stamp)
                  for n in dice.sample(range(40), 25 if not turn else 5)]
        events = [(str(1000 * turn + n), dice.choice([str(dice.randrange(30)), None]),
                   str(T0 + timedelta(seconds=dice.randrange(30 * 86400))), dice.choice("abcx"), None)
                  for n in range(200 if not turn else 30)]
        out.append({"deal": deals, "agent": agents, "event": events})
    # A batch of agents alone, and one that takes every deal of all other agents away.
    out.append({"agent": [("0", "x", "y9", None, str(T0 + timedelta(days=600)))]})
    out.append({"deal": [(str(n), "39", "1", "won", None, str(T0 + timedelta(days=700))) for n in range(80)]})
    return out


@pytest.mark.parametrize("period", ["week", "month"])
def test_marts_equal_their_operators_after_each_batch(spark, tmp_path, period):
    settings, root = layers.Settings(**{**SMALL, "period": period}), f"file://{tmp_path}/w"
    deliveries = odd_batches() if period == "week" else odd_batches()[:2]
    for number, delivery in enumerate(deliveries):
        run(spark, root, number, delivery, settings)
        assert_marts(spark, root, settings)
    assert not (tmp_path / "w/diff/agent_day").exists() or not list((tmp_path / "w/diff/agent_day").iterdir())


def test_only_touched_blocks_are_read_and_rewritten(spark, tmp_path, monkeypatch):
    settings, root = layers.Settings(**SMALL), f"file://{tmp_path}/w"
    made = [(str(n), str(n % 28), "1", "won", str(T0 + timedelta(days=n)), str(T0)) for n in range(200)]
    agents = [(str(n), "x", f"y{n % 3}", None, str(T0)) for n in range(28)]
    events = [(str(n), str(n % 28), str(datetime(2024, 1, 1 + n % 28)), "a", None) for n in range(100)]
    run(spark, root, 0, {"deal": made, "agent": agents, "event": events}, settings)
    read = []
    real = warehouse.read_table

    def watched(spark_, root_, table, *more):
        rows = real(spark_, root_, table, *more)
        if rows is not None:
            read.append((table, tuple(rows.inputFiles())))
        return rows
    monkeypatch.setattr(warehouse, "read_table", watched)
    # Agent 9 (block 1) has one more deal.
    run(spark, root, 1, {"deal": [("9000", "9", "5", "won", str(T0), str(T0 + timedelta(days=1)))]}, settings)
    monkeypatch.undo()
    tables = warehouse.committed(spark, root)[1]
    assert tables["state/agent_day"] == {"0": 0, "1": 1, "2": 0, "3": 0}
    assert tables["state/agent_total"]["1"] == 1 and tables["state/agent_total"]["2"] == 0
    assert set(tables["state/agency_day"].values()) == {0, 1} or len(tables["state/agency_day"]) == 1
    assert tables["cells/units"] == {"": 0} and tables["mart/funnel_snapshot"] == {"": 0}
    states_read = [f for t, files in read if t == "state/agent_day" for f in files if "mart" not in t]
    patches = [files for t, files in read if t == "state/agent_day"][:-1]
    assert states_read and all("/block=1/" in f for files in patches for f in files)
    assert not any(t == "fact/agent_stage_day" for t, _ in read)
    # Of facts only the blocks that the batch rewrote.
    written = set(tables["fact/agent_day"]) - {b for b, n in tables["fact/agent_day"].items() if n == 0}
    assert all(any(f"/block={b}/" in f for b in written) for t, files in read if t == "fact/agent_day" for f in files)


def test_a_warehouse_without_states_gets_them(spark, tmp_path, monkeypatch):
    settings, root = layers.Settings(**SMALL), f"file://{tmp_path}/w"
    first, second, third = batches()
    with monkeypatch.context() as patch:
        patch.setattr(states, "load_states", lambda *a: {})
        patch.setattr(states, "load_marts", lambda *a: [])
        run(spark, root, 0, first, settings)
    run(spark, root, 1, second, settings)
    assert_marts(spark, root, settings)


def test_rates_from_gaps_at_any_reference_date(spark):
    from datetime import date

    from dealscope.operators import churn, differences
    dice = random.Random(1)
    rows = [(dice.choice([None, *range(20)]), date(2024, 1, 1) + timedelta(days=dice.randrange(120)), 1, 1, Decimal(1)) for _ in range(300)]
    facts_ = spark.createDataFrame(rows, "agent_id long, deal_date date, deals long, won_deals long, volume decimal(38,2)")
    days = facts_.groupBy("agent_id", "deal_date").count().withColumn("w", differences.F.lit(1))
    gaps = differences.cell_changes(differences.gap_cells(days, "agent_id", "w"), ["day", "next_day"])
    for asof in (date(2024, 1, 20), date(2024, 2, 15), date(2024, 3, 31), date(2025, 1, 1)):
        for window in (5, 17, 40):
            assert differences.churn(gaps, window, asof).first() == churn.churn(facts_, window, asof).first(), (asof, window)
