"""Packing of token sequences into training sequences of several permitted lengths.

Best fit over the histogram of lengths, from the longest: a sequence goes to the
open bin with the least room that takes it; if none does, a bin of the least-cost
permitted length opens, cost per token that sequences of this length would fill.
At the end every bin shrinks to the least permitted length that holds its
contents. The plan is also made with each permitted length as the one that opens,
and the cheapest after shrinking is kept. Bins that look alike are one range, so
the plan's size follows from the permitted lengths, not from the corpus; sequences
take their places in it by their rank among those of the same length.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealscope.llm.mixing import word_count
from dealscope.llm.tables import kept, numbered

LENGTHS = (512, 1024, 2048, 4096, 8192)


class Packed(NamedTuple):
    """cuts: per length (sequences, first bin, sequences a bin, offset), in order of rank; bins: ranges of
    (first bin, bins, filled, length)."""

    cuts: dict[int, list[tuple[int, int, int, int]]]
    bins: list[tuple[int, int, int, int]]
    cost: float


def padded(length: int) -> float:
    """The cost of a bin: its length, so that the sum is tokens and padding."""
    return float(length)


def pack_histogram(counts: dict[int, int], lengths: tuple[int, ...] = LENGTHS,
                   cost: Callable[[int], float] = padded, opening: int | None = None) -> Packed:
    """Best fit of ``counts[n]`` sequences of each length n; ``opening`` fixes the length that opens if it fits."""
    lengths = tuple(sorted(lengths))
    rooms: list[int] = []
    open_: dict[int, list[tuple[int, int, int]]] = {}
    cuts: dict[int, list[tuple[int, int, int, int]]] = {}
    bins = 0

    def put(first: int, many: int, room: int, filled: int) -> None:
        if room not in open_:
            insort(rooms, room)
            open_[room] = []
        open_[room].append((first, many, filled))

    for size in sorted(counts, reverse=True):
        left, own = counts[size], cuts.setdefault(size, [])
        while left:
            at = bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                first, many, filled = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
            else:
                fitting = [n for n in lengths if n >= size]
                if not fitting:
                    raise ValueError(f"no permitted length holds {size}")

                def each(n: int) -> float:
                    return cost(n) / (min(left, n // size) * size)
                room = opening if opening in fitting else min(fitting, key=lambda n: (each(n), -n))
                if opening is not None and opening not in fitting:
                    room = fitting[0]
                first, filled = bins, 0
                many = max(1, left // (room // size))
                bins += many
            each_bin = min(room // size, left)
            used = min(many, left // each_bin)
            own.append((used * each_bin, first, each_bin, filled))
            left -= used * each_bin
            put(first, used, room - each_bin * size, filled + each_bin * size)
            if used < many:
                put(first + used, many - used, room, filled)
    ranges = sorted((first, many, filled, lengths[bisect_left(lengths, filled)])
                    for room in open_.values() for first, many, filled in room)
    return Packed(cuts, ranges, sum(many * cost(length) for _, many, _, length in ranges))


def best_plan(counts: dict[int, int], lengths: tuple[int, ...] = LENGTHS,
              cost: Callable[[int], float] = padded) -> Packed:
    """The cheapest of the plans that open by cost or at one permitted length."""
    return min((pack_histogram(counts, lengths, cost, opening) for opening in (None, *sorted(lengths, reverse=True))),
               key=lambda plan: plan.cost)


def packed(rows: DataFrame, key: list[str], length: str, lengths: tuple[int, ...] = LENGTHS,
           cost: Callable[[int], float] = padded) -> DataFrame:
    """``key``, ``piece``, ``start``, ``tokens``, ``bin``, ``bin_offset``, ``bin_tokens``, ``bin_length``.

    A sequence longer than the largest permitted length is cut into pieces of that
    length and a rest; nothing is dropped. ``start`` is the piece's first token in
    its sequence, ``bin_offset`` its place in the bin, ``bin_tokens`` what the bin
    holds, ``bin_length`` its permitted length. Bins count from 0. Sequences of null
    or no length give no piece. Equal lengths take their places by ``key`` and piece.
    """
    longest = max(lengths)
    size = F.col(length).cast("long")
    cut = rows.where(size > 0).select(*key, size.alias("_all"), F.explode(
        F.sequence(F.lit(0).cast("long"), F.floor((size - 1) / longest).cast("long"))).alias("piece"))
    cut = cut.select(*key, "piece", (F.col("piece") * longest).alias("start"),
                     F.least(F.col("_all") - F.col("piece") * longest, F.lit(longest)).cast("int").alias("tokens"))
    cut = kept(cut, "pieces")
    counts = {r["tokens"]: r["count"] for r in cut.groupBy("tokens").count().collect()}
    plan = best_plan(counts, lengths, cost)
    table = {n: tuple(np.array(x, np.int64) for x in zip(*own)) for n, own in plan.cuts.items()}
    ranges = tuple(np.array(x, np.int64) for x in zip(*plan.bins)) if plan.bins else ()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = np.asarray(batch.column(batch.schema.get_field_index("tokens")))
            rank = np.asarray(batch.column(batch.schema.get_field_index("_rank")))
            bins, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(tokens).tolist():
                mine = tokens == n
                many, first, each, filled = table[n]
                ends = np.cumsum(many)
                at = np.searchsorted(ends, rank[mine], "right")
                inside = rank[mine] - (ends[at] - many[at])
                bins[mine] = first[at] + inside // each[at]
                offset[mine] = filled[at] + inside % each[at] * n
            at = np.searchsorted(ranges[0], bins, "right") - 1 if len(bins) else bins
            keep = [c for c in batch.schema.names if c != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in keep), pa.array(bins),
                 pa.array(offset, pa.int32()), pa.array(ranges[2][at] if len(bins) else at, pa.int32()),
                 pa.array(ranges[3][at] if len(bins) else at, pa.int32())],
                [*keep, "bin", "bin_offset", "bin_tokens", "bin_length"])

    ranked = numbered(cut, ["tokens"], [*key, "piece"], "_rank")
    schema = cut.schema.add("bin", "long").add("bin_offset", "integer").add(
        "bin_tokens", "integer").add("bin_length", "integer")
    return ranked.mapInArrow(place, schema)


def document_packing(docs: DataFrame, lengths: tuple[int, ...] = LENGTHS) -> DataFrame:
    """Packing of documents by their words."""
    return packed(docs.select("doc_id", word_count().alias("_words")), ["doc_id"], "_words", lengths)
