"""Rows that a source no longer has, found by digests of key ranges.

Both sides count the keys of a range and sum two mixes of them. Ranges whose
digests agree hold the same keys; the others are cut into FAN smaller ones, level
by level, until they are short enough to compare key by key. So of two tables that
differ in d keys about FAN digests per level and differing range are compared, and
only the keys of the last ranges leave the source.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAN = 64
#: Widths of key ranges that are compared key by key.
LEAF = 4096
# Two primes below 2^31; the digests sum keys and their products modulo these, exactly, in any database.
PRIMES = (2147483647, 2147483629)

Digests = Callable[[int, int, "DataFrame | None", int], DataFrame]


def digest_columns(key: str, low: int, width: int) -> dict[str, str]:
    """The range of a key and its digests in plain SQL, that any database can run. Remainders are squared, so that a key
    can't make up for another by its sum."""
    parts = {"bucket": f"FLOOR(({key} - ({low})) / {width})", "many": "COUNT(*)"}
    for name, prime in zip(("mix_a", "mix_b"), PRIMES):
        rest = f"MOD(MOD({key}, {prime}) + {prime}, {prime})"
        parts[name] = f"SUM(MOD(CAST({rest} AS DECIMAL(38,0)) * {rest}, {prime}))"
    return parts


def digests_of(keys: DataFrame, key: str) -> Digests:
    """Digests of a table of keys: ``bucket, many, mix_a, mix_b`` for ranges of ``width`` keys from ``low`` on, within
    the ranges ``inside`` of ``outer`` keys each, or all."""
    known = keys.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("key"))

    def digests(low: int, width: int, inside: DataFrame | None, outer: int) -> DataFrame:
        rows = _inside(known, low, inside, outer)
        bucket = _bucket(F.col("key"), low, width)
        mixes = {}
        for name, prime in zip(("mix_a", "mix_b"), PRIMES):
            rest = F.pmod("key", F.lit(prime))
            # Below 2^62.
            mixes[name] = F.sum(F.pmod(rest * rest, F.lit(prime))).cast("decimal(38,0)")
        return rows.groupBy(bucket.alias("bucket")).agg(
            F.count(F.lit(1)).alias("many"), *[mix.alias(name) for name, mix in mixes.items()])
    return digests


def _bucket(key: Column, low: int, width: int) -> Column:
    # Whole numbers: a quotient of doubles would put large keys into wrong ranges.
    return F.call_function("div", key - F.lit(low) - F.pmod(key - F.lit(low), F.lit(width)), F.lit(width))


def _inside(keys: DataFrame, low: int, inside: DataFrame | None, outer: int) -> DataFrame:
    if inside is None:
        return keys
    ranges = inside.select(F.col("bucket").alias("_range"))
    return keys.join(ranges, _bucket(F.col("key"), low, outer) == F.col("_range"), "left_semi")


def differing(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """``bucket`` of the ranges whose digests aren't the same on both sides."""
    columns = ["bucket", "many", "mix_a", "mix_b"]
    sides = [rows.select(F.col("bucket").cast("bigint").alias("bucket"), F.col("many").cast("bigint").alias("many"),
                         *[F.col(m).cast("decimal(38,0)").alias(m) for m in columns[2:]], F.lit(sign).alias("side"))
             for rows, sign in ((ours, 1), (theirs, -1))]
    return sides[0].unionByName(sides[1]).groupBy(*columns).agg(F.sum("side").alias("side")).where("side <> 0").select(
        "bucket").distinct()


def deleted_keys(ours: DataFrame, theirs: DataFrame, key: str, keep: Callable[[DataFrame, str], DataFrame],
                 theirs_digests: Digests | None = None, fan: int = FAN, leaf: int = LEAF) -> DataFrame:
    """The keys of ``ours`` that ``theirs`` lacks, as a table with the one column ``key``.

    Both sides have integer keys; null ones are no keys, and repeated ones count as
    often as they come, so a range that repeats them is compared key by key. ``keep``
    writes a small table and reads it again (``rows, name``), so that a level is
    computed once. ``theirs_digests`` makes the source compute its own digests.
    """
    ours = ours.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("key"))
    theirs = theirs.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("key"))
    low, high = ours.agg(F.min("key"), F.max("key")).first()
    if low is None:
        return ours.select(F.col("key").alias(key))
    # Keys beyond ours can't be missing from theirs.
    theirs = theirs.where(F.col("key").between(low, high))
    own, other = digests_of(ours, "key"), theirs_digests or digests_of(theirs, "key")
    # Ranges of a level are whole parts of those before.
    outer = leaf
    while outer < high - low + 1:
        outer *= fan
    inside = None
    while outer > leaf:
        width = outer // fan
        found = differing(own(low, width, inside, outer), other(low, width, inside, outer))
        inside = keep(found, "ranges")
        outer = width
        if inside.isEmpty():
            break
    left = _inside(ours, low, inside, outer)
    return left.join(_inside(theirs, low, inside, outer), "key", "left_anti").select(F.col("key").alias(key)).distinct()


def range_filter(key: str, low: int, width: int, buckets: Sequence[int]) -> str:
    """The ranges as a condition for a database, neighbours joined."""
    runs: list[list[int]] = []
    for bucket in sorted(buckets):
        if runs and bucket == runs[-1][1]:
            runs[-1][1] = bucket + 1
        else:
            runs.append([bucket, bucket + 1])
    return " OR ".join(f"{key} >= {low + a * width} AND {key} < {low + b * width}" for a, b in runs) or "1 = 0"
