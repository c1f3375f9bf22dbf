"""Ranks over any number of rows without putting them in one task."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = "decimal(38,2)"
# Width of a slice, and slices of a block. A window group holds one row per
# distinct key of a slice or slice of a block, so about a million rows.
SLICE, BLOCK = 1e4, 1e6
# The place of rows without a key.
LAST = Decimal("9" * 36 + ".99")


def ranked(rows: DataFrame, key: Column, within: Sequence[str] = (), out: str = "rnk") -> DataFrame:
    """Add ``rank()`` by ``key``, a number of at most two decimals, smallest first,
    NULL last, ties sharing a rank.

    A window ordered over all rows would run in one task, and one partitioned by
    a dimension would put a dimension value that holds a third of the rows in
    one. Here the rank of a key is one plus the number of rows with a smaller
    key, found level by level: inside its slice of the key range, then over the
    slices of its block, then over the blocks. Slices follow from doubles, which
    keep the order of the keys whatever their size; only the keys themselves are
    compared exactly. Tied rows are counted together before the first window, so
    neither ties nor crowded slices make a group large.
    """
    # As a struct, a group whose name is NULL is a group like any other. With
    # neither groups nor keys NULL, the joins need no filters of their own and
    # the branches share their shuffles.
    group = ["_group"] if within else []
    ordered = {"_key": F.coalesce(key.cast(KEY), F.lit(LAST).cast(KEY))}
    tagged = rows.withColumns({**ordered, **({"_group": F.struct(*within)} if within else {})})

    # Counted by halves of a hash over all columns: the counting then reads just
    # what the result reads, and Spark computes the rows below once for both.
    even = F.xxhash64(*rows.columns) % 2 == 0
    keys = tagged.groupBy(*group, "_key").agg((F.count_if(even) + F.count_if(~even)).alias("_n"))
    keys = keys.withColumn("_slice", F.rint(F.col("_key").cast("double") / SLICE))
    slices = keys.groupBy(*group, "_slice").agg(F.sum("_n").alias("_n"))
    slices = slices.withColumn("_block", F.rint(F.col("_slice") / BLOCK))
    blocks = slices.groupBy(*group, "_block").agg(F.sum("_n").alias("_n"))

    in_all = blocks.select(*group, "_block", _before(group, "_block").alias("_b3"))
    in_block = slices.select(*group, "_block", "_slice", _before([*group, "_block"], "_slice").alias("_b2"))
    in_slice = keys.select(*group, "_slice", "_key", _before([*group, "_slice"], "_key").alias("_b1"))
    starts = in_block.join(in_all, [*group, "_block"]).drop("_block")
    places = in_slice.join(starts, [*group, "_slice"]).select(
        *group, "_key", (F.col("_b1") + F.col("_b2") + F.col("_b3") + 1).cast("bigint").alias(out))
    return tagged.join(places, [*group, "_key"]).select(*rows.columns, out)


def _before(group: Sequence[str], order: str) -> Column:
    """Rows counted in ``_n`` ahead of this one in its group."""
    window = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_n").over(window), F.lit(0))
