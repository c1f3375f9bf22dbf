"""Relational CRM tables over JDBC: incremental, chunked reads, and a table sink."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from dealscope.operators.deletions import Digests, digest_columns, range_filter
from dealscope.operators.versions import incremental

FETCH_ROWS = 10_000
#: Key ranges that one query names.
MOST_RANGES = 500


@dataclass(frozen=True)
class CrmTable:
    """Where a table is, and the columns that chunk and order its rows.

    ``columns`` maps output names to the table's own.
    """

    url: str
    table: str
    key: str
    columns: dict[str, str]
    cursor: str | None = None
    num_chunks: int = 8
    properties: dict[str, str] = field(default_factory=dict)
    # How far back of the last cursor value a load reads, for rows committed late.
    overlap: timedelta = timedelta(0)


def read_crm(spark: SparkSession, source: CrmTable, since: datetime | None = None) -> DataFrame:
    """Rows of a table at or after ``since``, read in ``num_chunks`` key ranges.

    One query for one row finds the range of keys that changed; the chunks split
    that range, so an increment at the end of the table still uses all of them.
    The cursor filter and the column list are pushed to the database.
    """
    if since is not None:
        since -= source.overlap
    query = bounds_query(source.table, source.key, source.cursor, since)
    bounds = _reader(spark, source).option("query", query).load().first()
    low, high = (bounds[0], bounds[1]) if bounds else (None, None)
    reader = _reader(spark, source).option("dbtable", source.table)
    for name, value in chunk_options(source.key, low, high, source.num_chunks).items():
        reader = reader.option(name, value)
    rows = reader.load()
    if source.cursor:
        rows = incremental(rows, source.cursor, since)
    return rows.select(*[F.col(stored).alias(name) for name, stored in source.columns.items()])


def key_digests(spark: SparkSession, source: CrmTable) -> Digests:
    """Digests of the table's keys, made by the database, for :func:`dealscope.operators.deletions.deleted_keys`.

    Up to MOST_RANGES ranges are asked for by name; of more the query returns all, and what isn't asked for is dropped.
    """
    def digests(low: int, width: int, inside: DataFrame | None, outer: int) -> DataFrame:
        wanted = None if inside is None else [r[0] for r in inside.select("bucket").limit(MOST_RANGES + 1).collect()]
        if wanted is not None and len(wanted) > MOST_RANGES:
            wanted = None
        where = f"{source.key} >= {low}" if wanted is None else range_filter(source.key, low, outer, wanted)
        columns = ", ".join(f"{what} AS {name}" for name, what in digest_columns(source.key, low, width).items())
        query = f"SELECT {columns} FROM {source.table} WHERE {where} GROUP BY {digest_columns(source.key, low, width)['bucket']}"
        rows = _reader(spark, source).option("query", query).load()
        if inside is None:
            return rows
        return rows.join(inside.select(F.col("bucket").alias("_outer")),
                         F.floor(F.col("bucket") * width / outer) == F.col("_outer"), "left_semi")
    return digests


def bounds_query(table: str, key: str, cursor: str | None, since: datetime | None) -> str:
    query = f"SELECT MIN({key}) AS low, MAX({key}) AS high FROM {table}"
    if cursor and since is not None:
        query += f" WHERE {cursor} >= '{since:%Y-%m-%d %H:%M:%S.%f}' OR {cursor} IS NULL"
    return query


def chunk_options(key: str, low: int | None, high: int | None, num_chunks: int) -> dict[str, str]:
    """Reader options that split ``[low, high]`` into equal key ranges.

    Ranges only steer the work: rows outside them go to the first and last chunk.
    """
    if low is None or high is None or num_chunks <= 1:
        return {}
    return {
        "partitionColumn": key,
        "lowerBound": str(low),
        "upperBound": str(high + 1),
        "numPartitions": str(min(num_chunks, high - low + 1)),
    }


def _reader(spark: SparkSession, source: CrmTable) -> DataFrameReader:
    reader = spark.read.format("jdbc").option("url", source.url).option("fetchsize", FETCH_ROWS)
    for name, value in source.properties.items():
        reader = reader.option(name, value)
    return reader


def write_jdbc(rows: DataFrame, url: str, table: str, connections: int = 8,
               properties: dict[str, str] | None = None) -> None:
    """Replace the contents of a database table, keeping its definition.

    Not atomic for readers of that table: the Parquet snapshot is the truth, and
    a database copy should be loaded beside the live table and renamed there.
    """
    writer = rows.write.format("jdbc").mode("overwrite")
    options = {"url": url, "dbtable": table, "truncate": "true", "numPartitions": str(connections),
               "batchsize": str(FETCH_ROWS), **(properties or {})}
    writer.options(**options).save()
