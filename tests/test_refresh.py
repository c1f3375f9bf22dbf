"""Refreshing in pieces gives what one load of everything gives."""

import random
from datetime import datetime, timedelta

import pytest

from dealscope.operators import facts, funnel, staging
from dealscope.plans import layers
from dealscope.schemas import AGENT, DEAL, EVENT
from dealscope.sources import warehouse
from dealscope.streaming import feeds, refresh

STAGES = ("a", "b", "c")
SETTINGS = layers.Settings(stages=STAGES, won="won", codes={"deal": {"status": {"won": "won", "выиграна": "won",
                                                                                "open": "open"}}},
                           agent_days=90, agency_days=30, block_ids=50)
T0 = datetime(2024, 1, 1)
COLUMNS = {"deal": DEAL, "agent": AGENT, "event": EVENT}


def batches(seed=1):
    """Three deliveries: changed and repeated deals, moved agents, repeated events."""
    pick = random.Random(seed)
    deals, events = [], []
    for n in range(300):
        agent = 0 if n % 3 == 0 else pick.randrange(40)
        for version in range(pick.randrange(1, 4)):
            made = T0 + timedelta(days=pick.randrange(400))
            deals.append((str(n), str(agent), f"{pick.randrange(99999) / 100:.2f}".replace(".", ","),
                          pick.choice(("won", " Выиграна", "open", "???")), str(made),
                          str(T0 + timedelta(days=500 + version))))
    for n in range(900):
        when = T0 + timedelta(seconds=pick.randrange(20 * 86400))
        events.append((str(n), str(0 if n % 3 == 0 else pick.randrange(40)), str(when), pick.choice("abcx"), None))
    events += pick.sample(events, 200)
    events.append(("9000", "1", None, "a", None))
    agents = [(str(n), f" Agent «{n}» ", f"y{n % 5}", "+7 (1)", None) for n in range(40)]
    moved = [("3", "Agent 3", "y0", "8", None)]
    pick.shuffle(deals)
    pick.shuffle(events)
    third = lambda rows, i: rows[i::3]
    out = [{"deal": third(deals, i), "agent": third(agents, i), "event": third(events, i)} for i in range(3)]
    out[2]["agent"] = out[2]["agent"] + moved
    out[2]["deal"] = out[2]["deal"] + out[0]["deal"]
    return out


def frame(spark, name, rows):
    names = COLUMNS[name].schema.fieldNames()
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names))


def contents(spark, root):
    _, tables = warehouse.committed(spark, root)
    result = {}
    for table in tables:
        rows = warehouse.read_table(spark, root, table, tables=tables)
        rows = rows.select(*sorted(c for c in rows.columns if c not in staging.ARRIVAL))
        result[table] = sorted(map(str, rows.collect()))
    return result


@pytest.fixture(scope="module")
def full(spark, tmp_path_factory):
    """One cycle over everything, later deliveries standing for later batches."""
    root = f"file://{tmp_path_factory.mktemp('full')}"
    for number, batch in enumerate(batches()):
        layers.run_cycle(spark, root, number, layers.tag({n: frame(spark, n, r) for n, r in batch.items()}), SETTINGS)
    return contents(spark, root)


def test_streamed_pieces_equal_batches(spark, tmp_path, full):
    """Files land before each of three runs of one stream with one checkpoint."""
    root, landing = f"file://{tmp_path}/w", tmp_path / "landing"
    folders = {name: f"file://{landing}/{name}" for name in (*COLUMNS, "company")}
    for number, batch in enumerate(batches()):
        for name, rows in batch.items():
            refresh.land(frame(spark, name, rows), name, folders[name])
        refresh.refresh(spark, refresh.feed_streams(spark, folders), root, f"file://{tmp_path}/c", SETTINGS,
                        feeds.AVAILABLE_NOW)
        assert warehouse.committed(spark, root)[0] == number
    assert contents(spark, root) == full
    assert warehouse.last_seen(spark, root, "deal") == T0 + timedelta(days=502)
    assert warehouse.last_seen(spark, root, "event") is None


def test_marts_equal_marts_of_the_final_rows(spark, tmp_path, full):
    """A single load of the latest versions only, in one batch."""
    latest = {}
    for batch in batches():
        for row in batch["deal"]:
            if row[0] not in latest or row[5] >= latest[row[0]][5]:
                latest[row[0]] = row
    agents = {row[0]: row for batch in batches() for row in batch["agent"]}
    events = {row[0]: row for batch in batches() for row in batch["event"]}
    root = f"file://{tmp_path}"
    once = {"deal": list(latest.values()), "agent": list(agents.values()), "event": list(events.values())}
    layers.run_cycle(spark, root, 0, layers.tag({n: frame(spark, n, r) for n, r in once.items()}), SETTINGS)
    got = contents(spark, root)
    assert got["mart/rating_agent"] and {t: r for t, r in got.items() if not t.startswith("typed")} == full


def test_failed_cycle_shows_nothing_and_can_run_again(spark, tmp_path, monkeypatch, full):
    root = f"file://{tmp_path}"
    tagged = [layers.tag({n: frame(spark, n, r) for n, r in b.items()}) for b in batches()]
    layers.run_cycle(spark, root, 0, tagged[0], SETTINGS)
    before = contents(spark, root)
    with monkeypatch.context() as broken:
        broken.setattr(layers.states.diff, "cohort_size", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            layers.run_cycle(spark, root, 1, tagged[1], SETTINGS)
    assert contents(spark, root) == before
    layers.run_cycle(spark, root, 1, tagged[1], SETTINGS)
    layers.run_cycle(spark, root, 1, tagged[2], SETTINGS)
    layers.run_cycle(spark, root, 2, tagged[2], SETTINGS)
    assert contents(spark, root) == full


def test_refused_cells_and_untouched_blocks(spark, tmp_path):
    root = f"file://{tmp_path}"
    first, second = batches()[0], {"deal": [("0", "1", "oops", "won", str(T0), str(T0 + timedelta(900)))]}
    for number, batch in enumerate((first, second)):
        layers.run_cycle(spark, root, number, layers.tag({n: frame(spark, n, r) for n, r in batch.items()}), SETTINGS)
    _, tables = warehouse.committed(spark, root)
    assert tables["staging/deal"] == {"0": 1, "1": 0, "2": 0, "3": 0, "4": 0, "5": 0}
    assert tables["fact/agent_day"] == tables["staging/deal"]
    assert tables["mart/rating_agent"] == {"": 1} and tables["mart/funnel_ordered"] == {"": 0}
    refused = [tuple(r) for r in layers.rejected(spark, root, DEAL).where("column = 'amount'").collect()]
    assert refused == [(0, "amount", "oops")]


def test_a_new_checkpoint_on_an_old_warehouse_loses_nothing(spark, tmp_path):
    root, folders = f"file://{tmp_path}/w", {"agent": f"file://{tmp_path}/agent"}
    for number, name in enumerate(("one", "two")):
        refresh.land(frame(spark, "agent", [(str(number), name, "y", None, None)]), "agent", folders["agent"])
        refresh.refresh(spark, refresh.feed_streams(spark, folders), root, f"file://{tmp_path}/c{number}", SETTINGS,
                        feeds.AVAILABLE_NOW)
    names = {r.agent_name for r in warehouse.read_table(spark, root, "staging/agent").collect()}
    assert names == {"one", "two"} and warehouse.committed(spark, root)[0] == 1


def test_events_without_agent_and_corrected_stages(spark, tmp_path):
    """The published funnel is that of the operator on the staged rows."""
    root = f"file://{tmp_path}"
    first = [("1", "1", str(T0), "a", None), ("2", None, str(T0), "a", None), ("3", None, str(T0), "b", None),
             ("4", "2", str(T0 + timedelta(days=1)), "b", None)]
    # The only stage event of the second day turns out to be none.
    corrected = [("4", "2", str(T0 + timedelta(days=1)), "x", None)]
    for number, rows in enumerate((first, corrected)):
        layers.run_cycle(spark, root, number, layers.tag({"event": frame(spark, "event", rows)}), SETTINGS)
    # ts equal in both versions: the staged row decides what the marts must show.
    staged = warehouse.read_table(spark, root, "staging/event")
    wanted = {
        "funnel_reached": funnel.funnel_reached(facts.stage_marks(staged, STAGES), 3, "week"),
        "funnel_ordered": funnel.funnel_ordered(funnel.stage_paths(staged, STAGES), 3, "week"),
    }
    for name, mart in wanted.items():
        rows = lambda f: sorted(map(str, f.select("stage_no", "units").collect()))
        assert rows(warehouse.read_mart(spark, root, name)) == rows(mart)


def test_a_block_without_stage_events_is_gone(spark, tmp_path):
    root = f"file://{tmp_path}"
    day = lambda code, seconds: [("4", "2", str(T0 + timedelta(seconds=seconds)), code, None)]
    other = [("1", "1", str(T0 + timedelta(days=3)), "a", None)]
    for number, rows in enumerate((day("b", 0) + other, day("x", 5))):
        layers.run_cycle(spark, root, number, layers.tag({"event": frame(spark, "event", rows)}), SETTINGS)
    units = {r.stage_no: r.units for r in warehouse.read_mart(spark, root, "funnel_reached").collect()}
    assert units == {1: 1, 2: 0, 3: 0}
