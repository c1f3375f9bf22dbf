"""Keys that a source has lost: found by few digests, and gone from all layers."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from dealscope.operators import deletions
from dealscope.plans import layers
from dealscope.sources import crm, warehouse
from dealscope.streaming import feeds, refresh
from tests.test_refresh import SETTINGS, T0, batches, frame
from tests.test_states import assert_marts


class Keeper:
    """Keeps tables in memory, and counts the ranges that differed."""

    def __init__(self):
        self.ranges = []

    def __call__(self, rows, name):
        kept = rows.collect()
        self.ranges.append(len(kept))
        return rows.sparkSession.createDataFrame(kept, rows.schema)


def keys(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id long")


@pytest.mark.parametrize("gone", [0, 1, 40])
@pytest.mark.parametrize("base", [-50_000, 10**15])
def test_lost_keys_are_found(spark, gone, base):
    dice = random.Random(gone)
    ours = [base + n * 7 for n in dice.sample(range(100_000), 20_000)]
    lost = set(dice.sample(ours, gone))
    theirs = [i for i in ours if i not in lost] + [base - 3, base + 10**9]
    keeper = Keeper()
    got = deletions.deleted_keys(keys(spark, ours + [None]), keys(spark, theirs + [None]), "id", keeper, leaf=512)
    assert {r.id for r in got.collect()} == lost
    # A level has at most FAN ranges for each that differed, and no more differ than keys are lost.
    assert all(n <= max(gone, 0) + 1 for n in keeper.ranges) and len(keeper.ranges) <= 3


def test_a_thousand_of_a_hundred_thousand(spark):
    ours = spark.range(100_000).select((F.col("id") * 1000).alias("id"))
    lost = F.col("id") % 100_000 == 7000
    keeper = Keeper()
    got = deletions.deleted_keys(ours, ours.where(~lost), "id", keeper)
    assert got.count() == 1000 and got.where(~lost).count() == 0
    assert max(keeper.ranges) <= 1001


def test_new_and_repeated_keys_of_the_source_are_no_deletions(spark):
    ours = keys(spark, range(0, 5000, 2))
    theirs = keys(spark, [*range(0, 5000), *range(0, 5000, 10)])
    assert deletions.deleted_keys(ours, theirs, "id", Keeper(), leaf=16).count() == 0
    # Two lost keys and two new ones in one range with the same count and sum.
    swapped = keys(spark, [{100: 101, 104: 103}.get(i, i) for i in range(0, 5000, 2)])
    assert {r.id for r in deletions.deleted_keys(ours, swapped, "id", Keeper(), leaf=16).collect()} == {100, 104}
    assert deletions.deleted_keys(ours.where("false"), theirs, "id", Keeper()).collect() == []
    assert deletions.deleted_keys(ours, theirs.where("false"), "id", Keeper(), leaf=16).count() == 2500


def test_a_database_makes_the_same_digests(spark):
    rows = keys(spark, [*range(-40, 3000, 3), 9, 9])
    rows.createOrReplaceTempView("crm_keys")
    for low, width in ((-40, 100), (0, 7)):
        columns = deletions.digest_columns("id", low, width)
        picked = ", ".join(f"{what} AS {name}" for name, what in columns.items())
        theirs = spark.sql(f"SELECT {picked} FROM crm_keys WHERE id >= {low} GROUP BY {columns['bucket']}")
        ours = deletions.digests_of(rows.where(F.col("id") >= low), "id")(low, width, None, 0)
        assert ours.count() > 9 and deletions.differing(ours, theirs).count() == 0
    assert deletions.range_filter("k", 10, 5, [3, 0, 1]) == "k >= 10 AND k < 20 OR k >= 25 AND k < 30"


def test_the_digest_query_names_few_ranges(spark):
    asked = []

    class Session:
        class read:
            @staticmethod
            def format(_):
                return Reader()

    class Reader:
        def option(self, name, value):
            if name == "query":
                asked.append(value)
            return self

        def load(self):
            return spark.createDataFrame([(0, 1, 1, 1), (5, 1, 1, 1)], "bucket long, many long, mix_a long, mix_b long")

    digests = crm.key_digests(Session, crm.CrmTable("jdbc:x", "deals", "id", {}))
    assert digests(0, 640, None, 40960).count() == 2
    inside = spark.createDataFrame([(0,)], "bucket long")
    assert [r.bucket for r in digests(0, 10, inside, 40).collect()] == [0]
    assert "WHERE id >= 0 GROUP BY" in asked[0] and "WHERE id >= 0 AND id < 40 GROUP BY" in asked[1]


def test_deleted_rows_leave_all_layers_and_may_come_back(spark, tmp_path):
    root, folders = f"file://{tmp_path}/w", {n: f"file://{tmp_path}/landing/{n}" for n in ("deal", "agent", "event")}

    def cycle():
        refresh.refresh(spark, refresh.feed_streams(spark, folders), root, f"file://{tmp_path}/c", SETTINGS, feeds.AVAILABLE_NOW)

    for name, rows in batches()[0].items():
        refresh.land(frame(spark, name, rows), name, folders[name])
    cycle()
    staged = warehouse.read_table(spark, root, "staging/deal")
    before = {r.deal_id for r in staged.collect()}
    # A whole block of deals and some of another go.
    left = staged.where("deal_id >= 50 AND deal_id % 7 <> 0").select("deal_id", "agent_id")
    refresh.land_deletions(spark, root, "deal", left, folders["deal"])
    cycle()
    after = {r.deal_id for r in warehouse.read_table(spark, root, "staging/deal").collect()}
    assert after == {i for i in before if i >= 50 and i % 7}
    assert warehouse.committed(spark, root)[1]["staging/deal"]["0"] == warehouse.EMPTY
    assert_marts(spark, root, SETTINGS)
    back = [("3", "1", "5", "won", str(T0), str(T0 + timedelta(days=900)))]
    refresh.land(frame(spark, "deal", back), "deal", folders["deal"])
    cycle()
    assert {r.deal_id for r in warehouse.read_table(spark, root, "staging/deal").collect()} == after | {3}
    assert_marts(spark, root, SETTINGS)
