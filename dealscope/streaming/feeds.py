"""File feeds as streams, and raw tables that take them in exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

AVAILABLE_NOW = {"availableNow": True}
EVERY_TEN_MINUTES = {"processingTime": "10 minutes"}


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def read_feed(spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*",
              form: str = "parquet", max_files: int = 1000, recursive: bool = True) -> DataFrame:
    """A stream of the files that appear in a folder or below it; ``max_files`` is
    the chunk of one batch. Without ``recursive`` folders below are partitions, whose
    values are columns of ``schema``."""
    return (
        spark.readStream.format(form).schema(schema)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", recursive)
        .option("maxFilesPerTrigger", max_files)
        .load(path)
    )


def append_raw(stream: DataFrame, source: str, path: str, checkpoint: str, trigger: dict) -> None:
    """Append a feed to a raw folder as text, and wait until it is in (or forever).

    The sink's own log makes each batch visible as a whole and only once.
    """
    raw = stream.select(
        *[F.col(c).cast("string").alias(c) for c in stream.columns],
        F.lit(source).alias("_source"),
        F.current_timestamp().alias("_ingested_at"),
    )
    query = (
        raw.writeStream.format("parquet").outputMode("append").trigger(**trigger)
        .option("checkpointLocation", checkpoint).option("path", path).start()
    )
    query.awaitTermination()
