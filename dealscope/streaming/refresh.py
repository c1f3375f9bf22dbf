"""The periodic refresh: one streaming query over all feeds.

Spark's trigger is the timer and its checkpoint the incremental cursor. Each
micro-batch is one cycle of the layers. The commit record keeps the query's id and
the micro-batch's number, so a batch that is run again after a failure replaces
itself, and a new checkpoint, which counts from 0 again, loses nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealscope.operators.deletions import Digests, deleted_keys
from dealscope.operators.staging import DELETED
from dealscope.plans.layers import Settings, run_cycle, tag
from dealscope.schemas import ENTITIES
from dealscope.session import shared_dir
from dealscope.sources import warehouse
from dealscope.sources.crm import CrmTable, read_crm
from dealscope.streaming.feeds import read_feed, text_schema

DAY_OF_CYCLES = 144


def land(rows: DataFrame, name: str, folder: str) -> None:
    """Append an extract to the folder that feeds an entity, as text.

    This is how relational, spreadsheet and API reads enter the refresh. An
    extract appears whole, by one rename, so a cursor never moves past rows that
    a failed extract left out. Landing one twice is harmless: only the latest
    version of a key counts.
    """
    spark, extract = rows.sparkSession, uuid.uuid4().hex
    columns = ENTITIES[name].schema.fieldNames()
    present = [F.col(c).cast("string").alias(c) if c in rows.columns else F.lit(None).cast("string").alias(c)
               for c in [*columns, *([DELETED] if DELETED in rows.columns else [])]]
    rows.select(*present).write.parquet(f"{folder}/_{extract}")
    warehouse.move(spark, f"{folder}/_{extract}", f"{folder}/{extract}")


def land_deletions(spark: SparkSession, root: str, name: str, source_keys: DataFrame, folder: str,
                   digests: Digests | None = None) -> None:
    """Land, as deleted, the staged rows of an entity whose keys ``source_keys`` lacks.

    ``source_keys`` has the entity's key, an integer, of every row that the source
    still has; ``digests`` lets the source compare ranges of them itself. Run it when
    all that was landed before is staged: a key that is only landed can't be missed.
    Should the source take a key again, its next version brings the row back.
    """
    staged, key = warehouse.read_table(spark, root, f"staging/{name}"), ENTITIES[name].key[0]
    if staged is None:
        return
    gone = deleted_keys(staged, source_keys, key, _kept, digests)
    land(staged.join(gone, key, "left_semi").withColumn(DELETED, F.lit("true")), name, folder)


def _kept(rows: DataFrame, name: str) -> DataFrame:
    path = shared_dir(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def pull_crm(spark: SparkSession, tables: dict[str, CrmTable], root: str, feeds: dict[str, str]) -> None:
    """Land what changed in the relational tables since the last visible cycle."""
    for name, table in tables.items():
        land(read_crm(spark, table, warehouse.last_seen(spark, root, name)), name, feeds[name])


def feed_streams(spark: SparkSession, feeds: dict[str, str], form: str = "parquet",
                 max_files: int = 1000) -> dict[str, DataFrame]:
    """A text stream per entity from the folder its extracts land in, which may still be missing.

    ``_landed`` is when a row's file landed: of two extracts in one batch the later one counts.
    """
    landed = F.unix_millis("_metadata.file_modification_time").alias("_landed")
    for path in feeds.values():
        warehouse.make_folder(spark, path)
    return {
        name: read_feed(spark, path, text_schema([*ENTITIES[name].schema.fieldNames(), DELETED]), form=form,
                        max_files=max_files).select("*", landed)
        for name, path in feeds.items()
    }


def refresh(spark: SparkSession, streams: dict[str, DataFrame], root: str, checkpoint: str,
            settings: Settings, trigger: dict, keep: int = DAY_OF_CYCLES) -> None:
    """Run cycles until the trigger ends (``availableNow``) or the job is stopped.

    The files of the last ``keep`` cycles stay for readers that began on them.
    """
    def cycle(rows: DataFrame, batch_id: int) -> None:
        run_cycle(rows.sparkSession, root, batch_id, rows, settings, warehouse.query_of(rows.sparkSession))
        warehouse.expire(rows.sparkSession, root, keep)

    query = (
        tag(streams).writeStream.trigger(**trigger)
        .option("checkpointLocation", checkpoint).foreachBatch(cycle).start()
    )
    query.awaitTermination()
