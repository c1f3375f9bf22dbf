"""Shards of bounded size from indivisible groups, by best-fit decreasing.

Groups go from the largest to the smallest into the shard with the least room
that still takes them; shards stand in a tree balanced by room. Groups of about
one size are alike, so the packing runs over size classes: every size up to
2^CLASS_BITS is its own class, above it 2^CLASS_BITS classes share each power of
two. That is at most (64 - CLASS_BITS) * 2^CLASS_BITS classes whatever the data,
the only thing the driver sees. A class counts at its largest size, so a capacity
holds; groups then take their places in the cuts of their class by rank.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealscope.llm.tables import kept, numbered, same

CLASS_BITS = 10


class SizeClass(NamedTuple):
    size: int
    count: int
    total: int


class Rooms:
    """Shards by their room, in a treap: the tightest that fits, insertion and removal in logarithmic time."""

    def __init__(self):
        self.root = None
        self._state = 0x2545F491

    def _priority(self) -> int:
        self._state = (self._state * 6364136223846793005 + 1442695040888963407) % 2**64
        return self._state >> 16

    def add(self, key: tuple[int, int]) -> None:
        left, right = self._split(self.root, key)
        self.root = self._merge(self._merge(left, [key, self._priority(), None, None]), right)

    def take(self, room: int) -> tuple[int, int] | None:
        """Remove and return the least key with at least ``room``."""
        left, right = self._split(self.root, (room, -1))
        if right is None:
            self.root = left
            return None
        node = right
        while node[2] is not None:
            node = node[2]
        key = node[0]
        _, rest = self._split(right, (key[0], key[1] + 1))
        self.root = self._merge(left, rest)
        return key

    def _split(self, node, key):
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _merge(self, left, right):
        if left is None or right is None:
            return left or right
        if left[1] > right[1]:
            left[3] = self._merge(left[3], right)
            return left
        right[2] = self._merge(left, right[2])
        return right


def best_fit(classes: list[SizeClass], capacity: int, most: int | None = None) -> list[list[tuple[int, int]]] | None:
    """For each class, from the largest, its cuts: (groups up to here, shard). None if ``most`` shards don't do."""
    rooms, opened, cuts = Rooms(), 0, []
    for size, count, _ in classes:
        own, placed = [], 0
        while placed < count:
            found = rooms.take(size)
            if found is None:
                if opened == most or size > capacity:
                    return None
                found, opened = (capacity, opened), opened + 1
            room, shard = found
            here = min(count - placed, room // size)
            placed += here
            own.append((placed, shard))
            rooms.add((room - here * size, shard))
        cuts.append(own)
    return cuts


def near_equal(classes: list[SizeClass], shards: int) -> list[list[tuple[int, int]]]:
    """Cuts for a given number of shards at the least capacity that best fit manages.

    Groups larger than an equal share get shards of their own, all but the last one.
    """
    rest = [SizeClass(*c) for c in classes]
    cuts: dict[int, list[tuple[int, int]]] = {i: [] for i in range(len(classes))}
    alone, at = 0, 0
    while at < len(rest) and shards - alone > 1:
        size, count, _ = rest[at]
        if count and size * (shards - alone) > sum(c.size * c.count for c in rest):
            cuts[at].append((classes[at].count - count + 1, alone))
            rest[at] = SizeClass(size, count - 1, 0)
            alone += 1
        elif count:
            break
        else:
            at += 1
    weight = sum(c.size * c.count for c in rest)
    low = max([-(-weight // (shards - alone)), *(c.size for c in rest if c.count)])
    high = low + max([c.size for c in rest if c.count], default=0)
    while low < high:
        middle = (low + high) // 2
        if best_fit(rest, middle, shards - alone) is None:
            low = middle + 1
        else:
            high = middle
    packed = best_fit(rest, high, shards - alone)
    while packed is None:
        high += max(1, high // 64)
        packed = best_fit(rest, high, shards - alone)
    return [cuts[i] + [(classes[i].count - rest[i].count + upto, alone + shard) for upto, shard in own]
            for i, own in enumerate(packed)]


def _class_of(size):
    """The size class as the largest size of it: round up to CLASS_BITS + 1 leading bits."""
    shift = F.greatest(F.length(F.bin(size)) - (CLASS_BITS + 1), F.lit(0))
    unit = F.pow(F.lit(2.0), shift).cast("long")
    return F.expr("1L") * F.ceil(size / unit).cast("long") * unit


def sharded(rows: DataFrame, group: list[str], size: str, shards: int | None = None,
            capacity: int | None = None) -> DataFrame:
    """``rows`` and their ``shard`` from 0: rows equal in ``group`` (null equals null) stay together.

    Give either ``capacity``, for as few shards as best fit needs (an error if a
    group exceeds it), or ``shards``, for that many of sizes near equal. Sizes
    must be positive. An empty table gives an empty one.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give shards or capacity")
    rows = kept(rows, "sharding")
    groups = rows.groupBy(*group).agg(F.sum(size).cast("long").alias("_bytes")).withColumn(
        "_class", _class_of(F.col("_bytes")))
    groups = kept(groups, "groups")
    found = groups.groupBy("_class").agg(F.max("_bytes").alias("size"), F.count(F.lit(1)).alias("count"),
                                         F.sum("_bytes").alias("total")).orderBy(F.desc("_class")).collect()
    classes = [SizeClass(r["size"], r["count"], r["total"]) for r in found]
    if shards is not None:
        cuts = near_equal(classes, shards)
    else:
        cuts = best_fit(classes, capacity)
        if cuts is None:
            raise ValueError("a group is larger than the capacity")
    # One row per class and cut; a class has a cut per shard at most, or per shard that it fills.
    plan = rows.sparkSession.createDataFrame(
        [(r["_class"], [c[0] for c in own], [c[1] for c in own]) for r, own in zip(found, cuts)],
        "_class long, _upto array<long>, _shards array<int>")
    ranked = numbered(groups, ["_class"], group, "_place")
    # Cuts that end at or before the place.
    cut = F.size(F.filter("_upto", lambda upto: upto <= F.col("_place")))
    to = {c: f"_group_{i}" for i, c in enumerate(group)}
    placed = ranked.join(plan, "_class").select(*[F.col(c).alias(n) for c, n in to.items()],
                                                F.element_at("_shards", cut + 1).alias("shard"))
    return rows.join(placed, same(to)).select(*rows.columns, "shard")


def document_shards(docs: DataFrame, shards: int) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for each row of ``docs``.

    The size is the UTF-8 length of the text (null: 0) plus 1; equal texts form a
    group, null texts one of their own with a null ``text_crc32``; sizes are kept
    near equal (law ``bytes``; ``grown_shard`` is null). ``slot`` counts each shard
    from 0 by ``doc_id``, null first. Texts are equal if a 64-bit hash, the
    32-bit checksum are.
    """
    rows = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"),
        F.xxhash64("text").alias("_hash"), F.col("text").isNull().alias("_none"))
    placed = sharded(rows, ["_hash", "text_crc32", "_none"], "size", shards=shards)
    slots = numbered(placed.select("doc_id", "size", "text_crc32", "shard"), ["shard"], ["doc_id", "text_crc32"], "slot")
    return slots.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
