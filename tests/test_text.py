"""Cleaning, normalising and typing of dirty cells."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dealscope.functions import text
from dealscope.operators import staging
from dealscope.schemas import DEAL, Entity
from pyspark.sql import types as T


def apply(spark, function, cells):
    rows = spark.createDataFrame(list(enumerate(cells)), "n int, cell string")
    return [r.out for r in rows.select("n", function(F.col("cell")).alias("out")).orderBy("n").collect()]


def test_clean(spark):
    assert apply(spark, text.clean, ["  a \t b ", "", "   ", None, "\u00a01 \u202f234\u00a0"]) == [
        "a b", None, None, None, "1 234"]


def test_fold_name(spark):
    assert apply(spark, text.fold_name, ["  ООО «Дом»  ", '"A" Team', "''", None]) == [
        "ооо дом", "a team", None, None]


def test_digits(spark):
    assert apply(spark, text.digits, ["+7 (912) 345-67-89", "none", None]) == ["79123456789", None, None]


def test_parse_decimal(spark):
    clean_decimal = lambda cell: text.parse_decimal(text.clean(cell))
    assert apply(spark, clean_decimal, ["1 234,50", "1\u00a0234,50", "12.345", "12.340", "1x", "", None, "-7",
                                       "9999999999999999.99", "99999999999999999"]) == [
        Decimal("1234.50"), Decimal("1234.50"), None, Decimal("12.34"), None, None, None, Decimal("-7.00"),
        Decimal("9999999999999999.99"), None]


@pytest.mark.parametrize("cell, want", [
    ("31.12.2024", datetime(2024, 12, 31)),
    ("31.12.2024 23:59", datetime(2024, 12, 31, 23, 59)),
    ("31.12.2024 23:59:58", datetime(2024, 12, 31, 23, 59, 58)),
    ("2024-12-31", datetime(2024, 12, 31)),
    ("2024-12-31 10:20:30.5", datetime(2024, 12, 31, 10, 20, 30, 500000)),
    ("45292", datetime(2024, 1, 1)),
    ("45292.5", datetime(2024, 1, 1, 12)),
    ("31.02.2024", None), ("xx", None), ("2024", None), (None, None),
])
def test_parse_timestamp(spark, cell, want):
    assert apply(spark, text.parse_timestamp, [cell]) == [want]


def test_to_code(spark):
    codes = {"Won": "won", "выиграна": "won", "open": "open"}
    got = apply(spark, lambda c: text.to_code(c, codes), [" WON ", "«Выиграна»", "open", "lost", None])
    assert got == ["won", "won", "open", None, None]


THING = Entity(
    "thing",
    T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                  T.StructField("amount", T.DecimalType(18, 2)), T.StructField("day", T.DateType())]),
    ("id",), ("day",))


def test_typing_keeps_rows_and_reports_cells(spark):
    raw = spark.createDataFrame(
        [("1", " Ann ", "1 234,50", "31.12.2024"), ("2", "", "1x", "xx"), (None, "lost", "1", ""), ("k", "bad", "2", "")],
        "id string, name string, amount string, day string")
    typed = staging.type_raw(raw, THING)
    assert typed.count() == 4
    refused = {tuple(r) for r in staging.rejects(typed, ["id"]).collect()}
    assert refused == {(2, "amount", "1x"), (2, "day", "xx"), (None, "id", None), (None, "id", "k")}
    settled = {tuple(r) for r in staging.settle(typed, THING).collect()}
    assert settled == {(1, "Ann", Decimal("1234.50"), date(2024, 12, 31)), (2, None, None, None)}


def test_unknown_status_is_refused(spark):
    raw = spark.createDataFrame([("1", "won"), ("2", "??")], "deal_id string, status string")
    for name in ("agent_id", "amount", "deal_ts", "updated_at"):
        raw = raw.withColumn(name, F.lit(None).cast("string"))
    typed = staging.type_raw(raw, DEAL, codes={"status": {"won": "won"}})
    assert [tuple(r) for r in staging.rejects(typed, ["deal_id"]).collect()] == [(2, "status", "??")]


def test_clean_and_normalise_steps(spark):
    rows = spark.createDataFrame([(" 1 ", " «A»  b ", "8 (1) 2", "Yes"), ("", "x", "y", "no")],
                                 "id string, name string, phone string, answer string")
    out = staging.normalise(staging.clean(rows, ["id", "name"], ["id"]), ["name"], ["phone"],
                            {"answer": {"yes": "Y"}})
    assert [tuple(r) for r in out.collect()] == [("1", "a b", "812", "Y")]
