"""Tables kept between steps, and places within a key without one task per key."""

from __future__ import annotations

import gc
from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dealscope.session import remove, shared_dir

#: Folders of the tables kept so far within the innermost settled step.
_KEPT: ContextVar[list[str] | None] = ContextVar("_KEPT", default=None)


def kept(rows: DataFrame, label: str) -> DataFrame:
    """Rows written to the shared folder and read again: several readers, one computation, and no
    dependence on the executors that made them."""
    path = shared_dir(rows.sparkSession, label)
    if (held := _KEPT.get()) is not None:
        held.append(path)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def settled(step: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A step whose result is written before it returns; the tables it kept on the way are deleted then.

    For results much smaller than those tables. If the step fails, they stay.
    """
    @wraps(step)
    def run(*args, **options) -> DataFrame:
        held: list[str] = []
        token = _KEPT.set(held)
        try:
            result = step(*args, **options)
        finally:
            _KEPT.reset(token)
        result = kept(result, step.__name__.strip("_"))
        for path in held:
            remove(result.sparkSession, path)
        free_shuffles(result.sparkSession)
        return result
    return run


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that are over: it does so when the driver collects its garbage,
    which a driver with little to do would put off past the steps that need the disk."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def same(pairs: dict[str, str]) -> Column:
    """Equality of columns, by their names on both sides, in which null equals null."""
    condition = F.lit(True)
    for left, right in pairs.items():
        condition = condition & F.col(left).eqNullSafe(F.col(right))
    return condition


def numbered(rows: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` and in ``name`` each row's place from 0 within ``keys``, by ``order``, without gaps.

    Rows are dealt out by ranges of (keys, order), so a hot key fills several
    tasks. Each task numbers its rows in passing; only the row counts of a key in
    a task, at most tasks plus keys of them, are summed up. Rows equal in keys and
    order come in any sequence, fixed once the table is written.
    """
    part, at = "_numbered_part", "_numbered_at"
    dealt = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    held = kept(dealt.withColumns({part: F.spark_partition_id(), at: F.monotonically_increasing_id()}), "numbered")
    counts = held.groupBy(part, *keys).agg(F.min(at).alias("_first"), F.count(F.lit(1)).alias("_count"))
    earlier = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    to = {c: f"_base_{i}" for i, c in enumerate([part, *keys])}
    bases = counts.select(*[F.col(c).alias(n) for c, n in to.items()], (
        F.coalesce(F.sum("_count").over(earlier), F.lit(0)) - F.col("_first")).alias("_base"))
    return held.join(bases, same(to), "left").select(*rows.columns, (F.col(at) + F.col("_base")).alias(name))
