"""What a row belonged to at its own time: validity intervals from versions, and a join on key and interval.

A join on the key alone would send all rows of a hot key to one task, with the
range left as a filter. Here both sides also carry a bucket of time: an interval is
repeated for the buckets that it overlaps, but only for those in which its key has
rows, so it is never repeated for an empty calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DAYS = 30


def intervals(versions: DataFrame, key: str, value: str, since: str) -> DataFrame:
    """``key, value, valid_from, valid_to``: the periods in which a key had a value, from the versions of a key.

    A version counts from its ``since`` on, the first one from ever. Of versions of one
    moment the greatest value counts, versions without a time are older than all
    others, and equal neighbours are one interval. ``valid_to`` is the first moment
    after, null for the last. A key's versions are ordered in one task after equal ones
    are dropped: there are as many as the key had changes.
    """
    rows = versions.where(F.col(key).isNotNull()).groupBy(key, F.col(since).alias("_since")).agg(F.max(value).alias(value))
    order = Window.partitionBy(key).orderBy(F.col("_since").asc_nulls_first())
    place = F.row_number().over(order)
    changed = rows.withColumns({"_place": place, "_before": F.lag(value).over(order)}).where(
        (F.col("_place") == 1) | ~F.col(value).eqNullSafe(F.col("_before")))
    return changed.select(
        key, value, F.when(F.col("_place") > 1, F.col("_since")).alias("valid_from"),
        F.lead("_since").over(Window.partitionBy(key).orderBy("_place")).alias("valid_to"))


def valid_at(rows: DataFrame, periods: DataFrame, key: str, at: str, values: Sequence[str],
             bucket_days: int = BUCKET_DAYS) -> DataFrame:
    """``rows`` with the ``values`` that their key had at the moment ``at``, null where it had none or either is null."""
    def bucket(moment: Column) -> Column:
        return F.floor(F.unix_date(moment.cast("date")) / bucket_days)

    rows = rows.withColumn("_bucket", bucket(F.col(at)))
    active = rows.where(F.col(key).isNotNull() & F.col("_bucket").isNotNull()).select(key, "_bucket").distinct()
    overlap = (F.col("valid_from").isNull() | (F.col("_bucket") >= bucket(F.col("valid_from")))) & (
        F.col("valid_to").isNull() | (F.col("_bucket") <= bucket(F.col("valid_to"))))
    pieces = active.join(periods, key).where(overlap).select(
        F.col(key).alias("_key"), F.col("_bucket").alias("_piece"), "valid_from", "valid_to", *values)
    inside = (F.col("valid_from").isNull() | (F.col(at) >= F.col("valid_from"))) & (
        F.col("valid_to").isNull() | (F.col(at) < F.col("valid_to")))
    joined = rows.drop(*values).join(
        pieces, (F.col(key) == F.col("_key")) & (F.col("_bucket") == F.col("_piece")) & inside, "left")
    return joined.drop("_key", "_piece", "_bucket", "valid_from", "valid_to")
