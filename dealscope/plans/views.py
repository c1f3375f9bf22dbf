"""Canonical entities over the test tables, as text (raw) and typed.

The mapping is a stand-in that gives the operators realistic keys, ties and
gaps; see FIXTURES.md.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealscope.operators import facts, staging
from dealscope.plans.layers import Settings
from dealscope.schemas import AGENT, COMPANY, DEAL, EVENT, MANAGER, MARKET, SHOWING, SUPPORT
from dealscope.sources import warehouse
from dealscope.streaming.feeds import read_feed

# Event types standing for the five stages, and order statuses.
STAGES = ("signup", "view", "click", "purchase", "error")
STATUS_CODES = {"F": "won", "O": "open", "P": "partial"}
WON = "F"
# The tables have no change stamp for agents, agencies and managers; this day stands for it.
STAMP = "2000-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("deal_id"),
        F.col("o_custkey").alias("agent_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").cast("date").alias("deal_date"),
    )


def deal_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.deal_facts(deals(spark, sf_dir), WON)


def won_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of won deals only; the filter on the stored status reaches the scan."""
    return facts.deal_facts(deals(spark, sf_dir).where(F.col("status") == WON), WON)


def _agency_id(nation: str, segment: str):
    return F.concat_ws("|", F.col(nation).cast("string"), F.col(segment))


def agents_of(stored: DataFrame) -> DataFrame:
    return stored.select(
        F.col("c_custkey").alias("agent_id"),
        F.col("c_name").alias("agent_name"),
        _agency_id("c_nationkey", "c_mktsegment").alias("agency_id"),
    )


def stamped(rows: DataFrame) -> DataFrame:
    return rows.withColumn("updated_at", F.lit(STAMP))


def agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agents_of(table(spark, sf_dir, "customer"))


def agency_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agents' agencies over time: some years in, on a day of their own, agents go to the next nation's agency; every
    third one comes back 400 days later."""
    rows = table(spark, sf_dir, "customer")
    there = F.concat_ws("|", ((F.col("c_nationkey") + 1) % 25).cast("string"), "c_mktsegment")
    moved = F.date_add(F.lit("1996-01-01").cast("date"), (F.col("c_custkey") * 37 % 1800).cast("int"))
    own = _agency_id("c_nationkey", "c_mktsegment")
    versions = F.array(
        F.struct(own.alias("agency_id"), F.lit("1995-01-01").cast("date").alias("since")),
        F.struct(there.alias("agency_id"), moved.alias("since")),
        F.when(F.col("c_custkey") % 3 == 0, F.struct(own.alias("agency_id"), F.date_add(moved, 400).alias("since"))))
    return rows.select(F.col("c_custkey").alias("agent_id"), F.inline(F.array_compact(versions)))


def events_of(stored: DataFrame) -> DataFrame:
    return stored.select(
        "event_id",
        F.col("user_id").alias("agent_id"),
        "ts",
        F.col("event_type").alias("stage_code"),
        "props",
    )


def stage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_of(table(spark, sf_dir, "events"))


def stage_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.stage_marks(stage_events(spark, sf_dir), STAGES)


def raw_manager(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.to_raw(managers_of(table(spark, sf_dir, "supplier")), "crm", 0)


def managers_of(stored: DataFrame) -> DataFrame:
    return stamped(stored.select(F.col("s_suppkey").alias("manager_id"), F.col("s_name").alias("manager_name")))


def raw_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agencies, repeated for every agent that names them."""
    named = table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment").distinct()
    return staging.to_raw(companies_of(named, table(spark, sf_dir, "nation")), "crm", 0)


def companies_of(customers: DataFrame, nations: DataFrame) -> DataFrame:
    nations = nations.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return stamped(customers.join(nations, "c_nationkey").select(
        _agency_id("c_nationkey", "c_mktsegment").alias("agency_id"),
        F.concat_ws(" ", "n_name", "c_mktsegment").alias("agency_name"),
    ))


def raw_agent(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stamped(agents(spark, sf_dir).withColumn("phone", F.lit(None).cast("string")))
    return staging.to_raw(rows, "crm", 0)


def raw_agent_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agents as people type them: blanks and quote marks around names, phones with signs."""
    rows = table(spark, sf_dir, "customer").select(
        F.concat(F.lit(" "), "c_custkey", F.lit("\u00a0")).alias("agent_id"),
        F.concat(F.lit("  \u00ab"), F.upper("c_name"), F.lit("\u00bb\t ")).alias("agent_name"),
        F.concat(_agency_id("c_nationkey", "c_mktsegment"), F.lit("  ")).alias("agency_id"),
        F.when(F.col("c_nationkey") > 3, F.concat(F.lit("+7 ("), "c_nationkey", F.lit(") "), "c_custkey"))
        .otherwise("n/a").alias("phone"),
        F.lit("01.01.2000").alias("updated_at"),
    )
    return staging.to_raw(rows, "crm", 0)


def deal_versions(stored: DataFrame) -> DataFrame:
    return stored.select(
        F.col("o_orderkey").alias("deal_id"),
        F.col("o_custkey").alias("agent_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("deal_ts"),
        F.col("o_orderdate").alias("updated_at"),
    )


def raw_deal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.to_raw(deal_versions(table(spark, sf_dir, "orders")), "crm", 0)


def raw_deal_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deals as spreadsheets show them: ``1 234,50``, ``31.12.2000``; partial ones with a digit too many."""
    amount = F.col("amount")
    day = F.date_format("deal_ts", "dd.MM.yyyy HH:mm:ss")
    rows = deal_versions(table(spark, sf_dir, "orders")).select(
        "deal_id", "agent_id",
        F.when(F.col("status") == "P", F.concat(amount.cast("string"), F.lit("7")))
        .otherwise(F.translate(F.format_number(amount, 2), ",.", "\u00a0,")).alias("amount"),
        F.concat(F.lit(" "), F.lower("status"), F.lit("\n")).alias("status"),
        day.alias("deal_ts"), day.alias("updated_at"),
    )
    return staging.to_raw(rows, "workbook", 0)


def raw_showing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Showings scored by agents: every event stands for one."""
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("record_id"), F.col("user_id").alias("agent_id"),
        F.date_format("ts", "dd.MM.yyyy").alias("shown_at"), F.floor("value").alias("score"))
    return staging.to_raw(rows, "workbook", 0)


def raw_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Support cases: every order stands for one."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("case_id"), F.col("o_orderkey").alias("deal_id"),
        F.col("o_orderpriority").alias("status"), F.col("o_orderdate").alias("updated_at"))
    return staging.to_raw(rows, "workbook", 0)


def raw_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.to_raw(stage_events(spark, sf_dir), "crm", 0)


def raw_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.to_raw(market_of(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")), "market", 0)


def market_of(lines: DataFrame, parts: DataFrame) -> DataFrame:
    """Market deals; the stored line keys repeat, so the deal id is the whole line."""
    money = [F.col(c).cast("decimal(18,2)") for c in ("l_extendedprice", "l_quantity", "l_discount", "l_tax")]
    whole = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("date"), *money,
             "l_returnflag", "l_linestatus"]
    parts = parts.select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("object_type"))
    return lines.join(parts, "l_partkey").select(
        F.concat_ws("/", *[F.col(c) if isinstance(c, str) else c for c in whole]).alias("market_deal_id"),
        "object_type",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.col("l_quantity").cast("decimal(18,2)").alias("area"),
        F.col("l_shipdate").cast("date").alias("deal_date"),
    )


def feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The test tables of deals, agents and events as streams of extracts."""
    return {
        "deal": deal_versions(stream(spark, sf_dir, "orders")),
        "agent": stamped(agents_of(stream(spark, sf_dir, "customer")).withColumn("phone", F.lit(None).cast("string"))),
        "event": events_of(stream(spark, sf_dir, "events")),
    }


def side_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The test tables of agencies, managers and market deals as streams of extracts."""
    return {
        "company": companies_of(stream(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")),
        "manager": managers_of(stream(spark, sf_dir, "supplier")),
        "market": market_of(stream(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")),
    }


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream, whether it is one file or a folder of part files, perhaps in partitions."""
    path, schema = f"{sf_dir}/{name}.parquet", table(spark, sf_dir, name).schema
    if warehouse.is_folder(spark, path):
        return read_feed(spark, path, schema, recursive=False)
    return read_feed(spark, sf_dir, schema, f"{name}.parquet")


def staged(raw: DataFrame, entity, **rules) -> DataFrame:
    return staging.settle(staging.type_raw(raw, entity, **rules), entity).select(*entity.schema.fieldNames())


# How each entity is normalised on its way to staging.
RULES: dict[str, dict] = {
    DEAL.name: {"codes": {"status": STATUS_CODES}},
    AGENT.name: {"names": ["agent_name"], "phones": ["phone"]},
    COMPANY.name: {"names": ["agency_name"]},
    MANAGER.name: {"names": ["manager_name"]},
    EVENT.name: {},
    SHOWING.name: {},
    SUPPORT.name: {},
    MARKET.name: {"names": ["object_type"]},
}

SETTINGS = Settings(stages=STAGES, won="won", codes={"deal": {"status": STATUS_CODES}})
# Small blocks, so that the test tables fill several.
PATCHED = replace(SETTINGS, block_ids=50_000, agent_block=2_000)
