"""Snapshots, commit records, replays and expiry."""

import pytest

from dealscope.sources import warehouse as w


@pytest.fixture
def root(tmp_path):
    return f"file://{tmp_path}/warehouse"


def numbers(spark, low, high):
    return spark.range(low, high).withColumnRenamed("id", "n")


def seen(frame):
    return sorted(r.n for r in frame.collect())


def test_rows_without_a_commit_record_stay_invisible(spark, root):
    w.write_snapshot(numbers(spark, 0, 3), root, "mart/t", 0)
    assert w.committed(spark, root) == (-1, {})
    assert w.read_table(spark, root, "mart/t") is None
    with pytest.raises(LookupError):
        w.read_mart(spark, root, "t")
    w.publish(spark, root, 0, {"mart/t": {w.WHOLE: 0}})
    assert seen(w.read_mart(spark, root, "t")) == [0, 1, 2]


def test_replayed_batches(spark, root):
    w.write_atomic(numbers(spark, 0, 3), root, "mart/t", 5)
    w.write_atomic(numbers(spark, 0, 9), root, "mart/t", 5)
    assert seen(w.read_mart(spark, root, "t")) == [0, 1, 2]
    w.write_snapshot(numbers(spark, 0, 9), root, "mart/t", 6)
    w.write_atomic(numbers(spark, 7, 9), root, "mart/t", 6)
    assert seen(w.read_mart(spark, root, "t")) == [7, 8]
    w.publish(spark, root, 6, {"mart/t": {w.WHOLE: 99}})
    assert w.committed(spark, root)[0] == 6


def test_a_record_is_never_overwritten(spark, root):
    w.write_atomic(numbers(spark, 0, 1), root, "mart/t", 1)
    with pytest.raises(Exception, match="(?i)exist"):
        w._create(spark, f"{root}/_commits", f"{0:020d}.json", "{}")


def test_each_query_counts_its_own_batches(spark, root):
    """A number seen from one query is no replay when another brings it."""
    w.write_atomic(numbers(spark, 0, 1), root, "mart/t", 0, "old")
    w.write_atomic(numbers(spark, 5, 6), root, "mart/t", 0, "new")
    w.write_atomic(numbers(spark, 7, 8), root, "mart/t", 0, "old")
    assert seen(w.read_mart(spark, root, "t")) == [5] and w.committed(spark, root)[0] == 1


def test_an_emptied_block_is_not_read(spark, root):
    rows = numbers(spark, 0, 6).selectExpr("n", "CAST(n DIV 3 AS STRING) AS block")
    w.write_snapshot(rows, root, "fact/t", 0, block="block")
    w.publish(spark, root, 0, {"fact/t": {"0": 0, "1": 0}})
    w.publish(spark, root, 1, {"fact/t": {"0": w.EMPTY}})
    assert seen(w.read_table(spark, root, "fact/t")) == [3, 4, 5]
    assert w.read_table(spark, root, "fact/t", ["0"]) is None


def test_blocks_are_replaced_one_by_one(spark, root):
    rows = numbers(spark, 0, 6).selectExpr("n", "CAST(n DIV 3 AS STRING) AS block")
    w.write_snapshot(rows, root, "staging/t", 0, block="block")
    assert w.written_blocks(spark, root, "staging/t", 0) == ["0", "1"]
    w.publish(spark, root, 0, {"staging/t": {"0": 0, "1": 0}})
    w.write_snapshot(rows.selectExpr("n + 100 AS n", "block").where("block = '1'"), root, "staging/t", 1, block="block")
    w.publish(spark, root, 1, {"staging/t": {"1": 1}})
    assert seen(w.read_table(spark, root, "staging/t")) == [0, 1, 2, 103, 104, 105]
    assert seen(w.read_table(spark, root, "staging/t", ["1"])) == [103, 104, 105]
    assert w.read_table(spark, root, "staging/t", ["7"]) is None


def test_tables_of_one_record_belong_together(spark, root):
    w.write_atomic(numbers(spark, 0, 1), root, "mart/a", 0)
    _, tables = w.committed(spark, root)
    w.write_atomic(numbers(spark, 5, 6), root, "mart/a", 1)
    assert seen(w.read_table(spark, root, "mart/a", tables=tables)) == [0]
    assert seen(w.read_mart(spark, root, "a")) == [5]


def test_expire_keeps_what_recent_records_name(spark, root):
    for n in range(5):
        w.write_snapshot(numbers(spark, n, n + 1), root, "mart/a", n)
        w.publish(spark, root, n, {"mart/a": {w.WHOLE: n}, **({"mart/old": {w.WHOLE: 0}} if n == 0 else {})})
    w.write_snapshot(numbers(spark, 0, 1), root, "mart/old", 0)
    w.write_snapshot(numbers(spark, 9, 10), root, "mart/a", 7)
    assert sorted(w.expire(spark, root, keep=2)) == ["mart/a/batch_id=0", "mart/a/batch_id=1", "mart/a/batch_id=2"]
    assert seen(w.read_mart(spark, root, "a")) == [4]
    assert seen(w.read_mart(spark, root, "old")) == [0]
    assert seen(w.read_batch(spark, root, "mart/a", 7)) == [9]
    assert w.committed(spark, root)[0] == 4


def test_growing_tables(spark, root):
    for n in range(3):
        w.write_snapshot(numbers(spark, n, n + 1), root, "typed/t", n)
    for n in range(2):
        w.write_atomic(numbers(spark, 0, 1), root, "mart/a", n)
    assert seen(w.read_appended(spark, root, "typed/t")) == [0, 1]
