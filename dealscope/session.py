"""Session settings, and the shared folder for whatever a job must keep."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "dealscope", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the jobs are written for.

    On a cluster leave ``master`` to spark-submit and give
    ``spark.sql.shuffle.partitions`` as two to three times the cores; AQE merges
    what turns out small.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder that every executor can reach, under ``spark.checkpoint.dir``.

    Only a local master may do without that setting: there the machine's own
    temporary folder is shared by definition.
    """
    return f"{_base_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of :func:`shared_dir` that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def cut(rows: DataFrame) -> DataFrame:
    """Compute rows that several branches of a plan read once, and keep them in
    the shared folder, where they outlive the executors."""
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(_base_dir(rows.sparkSession))
    return rows.checkpoint()


def _base_dir(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="dealscope-")
