"""How a relational read is cut into chunks. No database is started here."""

from datetime import datetime

import pytest

from dealscope import schemas
from dealscope.sources import crm, warehouse
from dealscope.streaming import refresh


def test_chunks_cover_the_range():
    assert crm.chunk_options("id", 1, 1000, 8) == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "1001", "numPartitions": "8"}


def test_small_or_empty_ranges():
    assert crm.chunk_options("id", None, None, 8) == {}
    assert crm.chunk_options("id", 5, 5, 1) == {}
    assert crm.chunk_options("id", 5, 6, 8)["numPartitions"] == "2"


def test_bounds_only_look_at_the_increment():
    assert crm.bounds_query("deal", "id", None, None) == "SELECT MIN(id) AS low, MAX(id) AS high FROM deal"
    assert crm.bounds_query("deal", "id", "updated_at", datetime(2024, 1, 2, 3, 4, 5)).endswith(
        "FROM deal WHERE updated_at >= '2024-01-02 03:04:05.000000' OR updated_at IS NULL")


class Recorder:
    """Stands in for the reader and keeps what it is told."""

    def __init__(self, frame, log):
        self.frame, self.log = frame, log

    def format(self, name):
        self.log.append({"format": name})
        return self

    def option(self, name, value):
        self.log[-1][name] = value
        return self

    def load(self):
        if "query" in self.log[-1]:
            return self.frame.selectExpr("min(id) AS low", "max(id) AS high")
        return self.frame


@pytest.fixture
def session(spark):
    rows = spark.createDataFrame([(n, datetime(2024, 1, n), "x") for n in range(1, 10)],
                                 "id long, changed timestamp, other string")

    class Session:
        log = []
        read = Recorder(rows, log)

    return Session


TABLE = crm.CrmTable("jdbc:x", "deal", "id", {"deal_id": "id", "updated_at": "changed"}, "changed", 4, {"user": "u"})


def test_read_uses_bounds_filter_and_columns(session):
    got = crm.read_crm(session, TABLE, datetime(2024, 1, 7))
    assert [r.deal_id for r in got.collect()] == [7, 8, 9] and got.columns == ["deal_id", "updated_at"]
    assert session.log[1] == {"format": "jdbc", "url": "jdbc:x", "fetchsize": 10_000, "user": "u", "dbtable": "deal",
                              "partitionColumn": "id", "lowerBound": "1", "upperBound": "10", "numPartitions": "4"}


def test_pull_reads_on_from_the_last_cycle(spark, session, tmp_path, monkeypatch):
    root, folder = f"file://{tmp_path}/w", f"file://{tmp_path}/deal"
    monkeypatch.setattr(refresh, "read_crm", lambda _, table, since: crm.read_crm(session, table, since))
    refresh.pull_crm(spark, {"deal": TABLE}, root, {"deal": folder})
    assert spark.read.parquet(f"{folder}/*").count() == 9
    warehouse.publish(spark, root, 0, {}, {"deal": "2024-01-08 00:00:00"})
    warehouse.publish(spark, root, 1, {}, {"deal": "2024-01-02 00:00:00"})
    assert warehouse.last_seen(spark, root, "deal") == datetime(2024, 1, 8)
    refresh.pull_crm(spark, {"deal": TABLE}, root, {"deal": folder})
    landed = spark.read.parquet(f"{folder}/*")
    assert landed.count() == 11 and landed.where("deal_id = '8'").count() == 2
    assert landed.columns == schemas.DEAL.schema.fieldNames() and {k for _, k in landed.dtypes} == {"string"}
