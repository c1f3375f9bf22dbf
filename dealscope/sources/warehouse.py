"""Parquet tables published together by one commit record.

A table lives in ``<root>/<table>/batch_id=<n>/``, perhaps in ``block=<b>``
folders below. Writers fill the folders of their own batch; nothing is visible
until ``<root>/_commits/<n>.json`` appears, which a single rename does. The
record names, for every table, the batch that last wrote each of its blocks, so
a cycle rewrites the blocks it changed and readers see all tables at one moment.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The one block of a table that is always written whole.
WHOLE = ""
# In place of a batch: the block has no rows any more.
EMPTY = -1

Tables = dict[str, dict[str, int]]


def write_snapshot(rows: DataFrame, root: str, table: str, batch_id: int, block: str | None = None) -> None:
    """Write a batch of a table, replacing an earlier attempt at the same batch."""
    writer = rows.write.mode("overwrite")
    if block:
        writer = writer.partitionBy(block)
    writer.parquet(_folder(root, table, batch_id))


def publish(spark: SparkSession, root: str, batch_id: int, changed: Tables,
            cursors: dict[str, str] | None = None, source: tuple[str, int] | None = None) -> None:
    """Make a batch visible. Tables and blocks not in ``changed`` keep their state.

    ``cursors`` are the high-water marks reached, one per entity; ``source`` is
    the query the batch came from and its own number there. Publishing a
    batch that is already visible does nothing: a replayed cycle wrote the same
    rows.
    """
    record = _last_record(spark, root)
    if batch_id <= record["batch"]:
        return
    tables, marks = record["tables"], record["cursors"]
    for entity, mark in (cursors or {}).items():
        marks[entity] = max(mark, marks.get(entity, mark))
    for table, blocks in changed.items():
        kept = {} if WHOLE in blocks else tables.get(table, {})
        tables[table] = {**kept, **blocks}
    sources = {**record["sources"], **(dict([source]) if source else {})}
    body = json.dumps({"batch": batch_id, "tables": tables, "cursors": marks, "sources": sources}, sort_keys=True)
    _create(spark, f"{root}/_commits", f"{batch_id:020d}.json", body)


def write_atomic(rows: DataFrame, root: str, table: str, batch_id: int, source: str = "") -> None:
    """Write one table and publish it. A batch of ``source`` that is visible is left alone."""
    spark = rows.sparkSession
    number = next_batch(spark, root, source, batch_id)
    if number is None:
        return
    write_snapshot(rows, root, table, number)
    publish(spark, root, number, {table: {WHOLE: number}}, source=(source, batch_id))


def next_batch(spark: SparkSession, root: str, source: str, source_batch: int) -> int | None:
    """The number under which to write a batch of a query; None if it is visible already.

    Queries count from 0 on every new checkpoint, so a number alone doesn't tell
    a replay from new rows: the record keeps how far each query has come.
    """
    record = _last_record(spark, root)
    if source_batch <= record["sources"].get(source, -1):
        return None
    return record["batch"] + 1


def query_of(spark: SparkSession) -> str:
    """The id of the streaming query that runs this micro-batch; it lives in the checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""


def committed(spark: SparkSession, root: str) -> tuple[int, Tables]:
    """The last visible batch, ``-1`` if there is none, and its tables."""
    record = _last_record(spark, root)
    return record["batch"], record["tables"]


def last_seen(spark: SparkSession, root: str, entity: str) -> datetime | None:
    """The high-water mark of an entity, from which the next load reads on."""
    mark = _last_record(spark, root)["cursors"].get(entity)
    return datetime.fromisoformat(mark) if mark else None


def _last_record(spark: SparkSession, root: str) -> dict:
    names = _record_names(spark, root)
    if not names:
        return {"batch": -1, "tables": {}, "cursors": {}, "sources": {}}
    return {"sources": {}, **json.loads(_read(spark, f"{root}/_commits/{names[-1]}"))}


def _record_names(spark: SparkSession, root: str) -> list[str]:
    folder = _path(spark, f"{root}/_commits")
    system = _system(spark, folder)
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    return sorted(name for name in names if name.endswith(".json") and not name.startswith("."))


def read_table(spark: SparkSession, root: str, table: str, blocks: list[str] | None = None,
               tables: Tables | None = None, schema: str | None = None) -> DataFrame | None:
    """The visible rows of a table, or of some of its blocks; None if there are none.

    Readers that need several tables of one moment pass the ``tables`` of one
    :func:`committed` call. A known ``schema`` spares a look into the files.
    """
    if tables is None:
        tables = committed(spark, root)[1]
    state = tables.get(table, {})
    wanted = state if blocks is None else {b: state[b] for b in blocks if b in state}
    wanted = {b: n for b, n in wanted.items() if n != EMPTY}
    if not wanted:
        return None
    folders = [_folder(root, table, n) if b == WHOLE else f"{_folder(root, table, n)}/block={b}"
               for b, n in sorted(wanted.items())]
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*folders)


def read_batch(spark: SparkSession, root: str, table: str, batch_id: int) -> DataFrame:
    """One batch of a table, visible or not: what a cycle has just written."""
    return spark.read.parquet(_folder(root, table, batch_id))


def read_appended(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All visible batches of a table that only grows (raw and typed rows), with ``batch_id``."""
    return spark.read.parquet(f"{root}/{table}").where(F.col("batch_id") <= committed(spark, root)[0])


def written_blocks(spark: SparkSession, root: str, table: str, batch_id: int, block: str = "block") -> list[str]:
    """The blocks that a batch of a table has folders for."""
    folder = _path(spark, _folder(root, table, batch_id))
    names = [status.getPath().getName() for status in _system(spark, folder).listStatus(folder)]
    return sorted(name.removeprefix(f"{block}=") for name in names if name.startswith(f"{block}="))


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A mart as of the last commit, for whatever serves it."""
    rows = read_table(spark, root, f"mart/{name}")
    if rows is None:
        raise LookupError(f"mart {name} has not been published under {root}")
    return rows


def expire(spark: SparkSession, root: str, keep: int = 3) -> list[str]:
    """Delete batch folders that none of the last ``keep`` commit records names.

    Only batches up to the last visible one are considered, so a cycle that is
    being written is safe; tables that
    only grow are not named in the records, so they are never touched.
    """
    names = _record_names(spark, root)
    live, last = set(), -1
    known: set[str] = set()
    for name in names[-keep:]:
        record = json.loads(_read(spark, f"{root}/_commits/{name}"))
        last = max(last, record["batch"])
        for table, blocks in record["tables"].items():
            known.add(table)
            live |= {(table, n) for n in blocks.values()}
    gone = []
    system = _system(spark, _path(spark, root))
    for table in sorted(known):
        for status in system.listStatus(_path(spark, f"{root}/{table}")):
            number = status.getPath().getName().removeprefix("batch_id=")
            if number.isdigit() and int(number) <= last and (table, int(number)) not in live:
                system.delete(status.getPath(), True)
                gone.append(f"{table}/batch_id={number}")
    for name in names[:-keep]:
        system.delete(_path(spark, f"{root}/_commits/{name}"), False)
    return gone


def _folder(root: str, table: str, batch_id: int) -> str:
    return f"{root}/{table}/batch_id={batch_id}"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _read(spark: SparkSession, path: str) -> str:
    """A small file, read by the driver itself: a Spark job for each record would make cycles slow."""
    file = _path(spark, path)
    stream = _system(spark, file).open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _create(spark: SparkSession, folder: str, name: str, body: str) -> None:
    """Create a file that appears whole or not at all, failing if it exists."""
    draft, final = _path(spark, f"{folder}/.{uuid.uuid4().hex}"), _path(spark, f"{folder}/{name}")
    system = _system(spark, final)
    out = system.create(draft, False)
    try:
        out.write(bytearray(body.encode()))
    finally:
        out.close()
    move(spark, f"{folder}/{draft.getName()}", f"{folder}/{name}")


def is_folder(spark: SparkSession, path: str) -> bool:
    place = _path(spark, path)
    system = _system(spark, place)
    return system.exists(place) and system.getFileStatus(place).isDirectory()


def make_folder(spark: SparkSession, path: str) -> None:
    folder = _path(spark, path)
    _system(spark, folder).mkdirs(folder)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder in one step, failing if the target exists."""
    start, end = _path(spark, source), _path(spark, target)
    options = spark.sparkContext._gateway.new_array(
        spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        end.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(start, end, options)
