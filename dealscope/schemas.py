"""Typed schemas of the staging tables. Raw tables hold the same columns as text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


MONEY = T.DecimalType(18, 2)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


@dataclass(frozen=True)
class Entity:
    """A staging table: its columns, its key and what orders versions of a key."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    version: tuple[str, ...] = ()


LONG, TEXT, TIME, DAY = T.LongType(), T.StringType(), T.TimestampType(), T.DateType()

DEAL = Entity(
    "deal",
    _schema(deal_id=LONG, agent_id=LONG, amount=MONEY, status=TEXT, deal_ts=TIME, updated_at=TIME),
    ("deal_id",), ("updated_at",))
AGENT = Entity(
    "agent", _schema(agent_id=LONG, agent_name=TEXT, agency_id=TEXT, phone=TEXT, updated_at=TIME),
    ("agent_id",), ("updated_at",))
COMPANY = Entity(
    "company", _schema(agency_id=TEXT, agency_name=TEXT, updated_at=TIME), ("agency_id",), ("updated_at",))
MANAGER = Entity(
    "manager", _schema(manager_id=LONG, manager_name=TEXT, updated_at=TIME), ("manager_id",), ("updated_at",))
EVENT = Entity(
    "event", _schema(event_id=LONG, agent_id=LONG, ts=TIME, stage_code=TEXT, props=TEXT), ("event_id",), ("ts",))
SHOWING = Entity(
    "showing", _schema(record_id=LONG, agent_id=LONG, shown_at=DAY, score=MONEY), ("record_id",), ("shown_at",))
SUPPORT = Entity(
    "support", _schema(case_id=LONG, deal_id=LONG, status=TEXT, updated_at=TIME), ("case_id",), ("updated_at",))
MARKET = Entity(
    "market",
    _schema(market_deal_id=TEXT, object_type=TEXT, price=MONEY, area=MONEY, deal_date=DAY),
    ("market_deal_id",), ("deal_date", "price", "area", "object_type"))

ENTITIES = {e.name: e for e in (DEAL, AGENT, COMPANY, MANAGER, EVENT, SHOWING, SUPPORT, MARKET)}
