"""Exact Jaccard join of documents on word shingles, by partitioning the universe of shingles.

Two sets with Jaccard similarity of at least t differ in at most H shingles,
where H follows from their sizes. Cut the universe of shingles into segments and
allot each segment 1 (its subset must be equal) or 2 (it may differ by one
shingle): if the allotments of the segments sum to more than H, a similar pair
agrees in one segment within its allotment. So the index holds a hash of each
segment's subset and, for segments allotted 2, of the subset less each one of its
shingles. How many segments get 2 is a matter of cost: rows against subsets so
small that unrelated documents share them (``plan``). Empty subsets of segments
allotted 1 get nothing; E further segments pay for up to E of them, and a document
with more than E of them indexes them after all.

Sizes are cut into bands. A band's plan serves pairs whose smaller set is in the
band, so a set is indexed under its own band and those below that can hold a
smaller partner.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealscope.llm import words
from dealscope.llm.links import components
from dealscope.llm.tables import free_shuffles, kept, settled

BAND_RATIO = 1.5
#: Rows of the index that one expected meeting of unrelated documents is worth.
MEETING_COST = 8.0
#: Documents of an index entry that are compared with each other in one go.
BLOCK = 4096
#: Sets that a task remembers so as to index equal ones once.
COPIES = 50_000
#: Shingles of a group of documents that are compared with each other in one go; a document counts as a few hundred more.
SHINGLES = 1 << 21
#: Pairs that a component of an entry may propose: they connect nearly all that can be.
FIRST_PAIRS = 2
#: Close pairs that a task holds before it leaves out all but those.
HELD_PAIRS = 1 << 18


class Plan(NamedTuple):
    """Segments of a band: the first ``twos`` are allotted 2, the others 1; ``empties`` are paid for."""

    differences: int
    twos: int
    segments: int
    empties: int


def band_of(size: int) -> int:
    """The band b with edge(b) <= size < edge(b + 1)."""
    band = max(0, int(math.log(size, BAND_RATIO)) - 1)
    while edge(band + 1) <= size:
        band += 1
    return band


def edge(band: int) -> int:
    return math.ceil(BAND_RATIO**band)


@lru_cache(maxsize=None)
def plan(band: int, percent: int) -> Plan:
    """The cheapest allotment for sets whose smaller one has fewer than edge(band + 1) shingles."""
    small = edge(band + 1) - 1
    most = small * 100 // percent
    # |r - s| + |s - r| = |r| + |s| - 2 |r & s|, and 100 |r & s| >= percent |r | s|.
    differences = (small + most) * (100 - percent) // (100 + percent)
    size = (edge(band) + small) / 2
    best = None
    for twos in {round(share / 8 * (differences + 1) / 2) for share in range(9)}:
        ones = differences + 1 - 2 * twos
        if ones < 0:
            twos, ones = twos, 0
        mean = size / (twos + ones)
        empty = math.exp(-mean)
        rows = ones + twos * (1 + mean)
        meetings = ones * empty * (1 + mean) + twos * empty * (1 + mean + mean * mean / 2)
        if best is None or rows + MEETING_COST * meetings < best[0]:
            best = rows + MEETING_COST * meetings, twos, ones, empty
    _, twos, ones, empty = best
    spare = empty * ones
    empties = math.ceil(spare + 2 * math.sqrt(spare)) if spare > 0.05 else 0
    return Plan(differences, twos, twos + ones + empties, empties)


def bands_for(size: int, percent: int) -> list[int]:
    """Bands whose index a set of this size enters; none where only equal sets can be similar."""
    band = band_of(size)
    out = [band]
    while band and size * percent <= 100 * (edge(band) - 1):
        band -= 1
        out.append(band)
    return [band for band in out if plan(band, percent).differences]


def signatures(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Index entries of one sorted set of shingles."""
    out = []
    high = shingles >> np.uint64(32)
    total = np.zeros(len(shingles) + 1, np.uint64)
    np.cumsum(words.mix(shingles, 5), out=total[1:])
    for band in bands_for(len(shingles), percent):
        p = plan(band, percent)
        # Segments are ranges of the hash, hence slices of the sorted set.
        place = (high * np.uint64(p.segments)) >> np.uint64(32)
        bounds = np.searchsorted(place, np.arange(p.segments + 1, dtype=np.uint64))
        size = np.diff(bounds)
        name = words.mix(np.arange(p.segments, dtype=np.uint64), 11 + band)
        subset = total[bounds[1:]] - total[bounds[:-1]]
        used = size > 0
        used[:p.twos] = True
        if (~used).sum() > p.empties:
            used[:] = True
        out.append(words.mix(subset[used] + name[used]))
        if p.twos:
            inside = slice(0, bounds[p.twos])
            segment = place[inside].astype(np.int64)
            out.append(words.mix(subset[segment] - words.mix(shingles[inside], 5) + name[segment]))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def parity(shingles: np.ndarray) -> bytes:
    """Whether an odd number of shingles fell on each of at least as many bits as there are shingles."""
    bits = 1 << max(6, (max(1, len(shingles)) - 1).bit_length())
    places = (words.mix(shingles, 3) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=bits) & 1).astype(np.uint8)).tobytes()


def folded(bits: bytes, size: int) -> np.ndarray:
    """Parity bits as ``size`` 64-bit words, as if fewer bits had been taken."""
    out = np.frombuffer(bits, np.uint64)
    while len(out) > size:
        out = out[:len(out) // 2] ^ out[len(out) // 2:]
    return out


def differing_bits(left: bytes, right: bytes) -> int:
    """A lower bound of the number of shingles in just one of two sets."""
    size = min(len(left), len(right)) // 8
    return int(np.bitwise_count(folded(left, size) ^ folded(right, size)).sum())


def candidates(sizes: np.ndarray, bits: list[bytes], components: np.ndarray, blocks: np.ndarray, percent: int,
               groups: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """A place, earlier places that may be similar to it, and their differing bits.

    Pairs are of different components, of different groups and, if there are two,
    of different blocks. The caller may unite components or groups as it goes.
    """
    size = min(len(b) for b in bits) // 8
    table = np.stack([folded(b, size) for b in bits])
    two = blocks.min() != blocks.max()
    for a in range(1, len(sizes)):
        fits = (components[:a] != components[a]) & (sizes[:a] * 100 >= sizes[a] * percent) & (
            sizes[a] * 100 >= sizes[:a] * percent)
        if two:
            fits &= blocks[:a] != blocks[a]
        if groups is not None:
            fits &= groups[:a] != groups[a]
        b = np.flatnonzero(fits)
        differing = np.bitwise_count(table[b] ^ table[a]).sum(axis=1, dtype=np.int64)
        near = differing * (100 + percent) <= (sizes[b] + sizes[a]) * (100 - percent)
        if near.any():
            yield a, b[near], differing[near]


def _ranks(keys: np.ndarray) -> np.ndarray:
    """The place of each element among the equal ones before it."""
    order = np.argsort(keys, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], np.diff(keys[order]) != 0]))
    out = np.empty(len(keys), np.int64)
    out[order] = np.arange(len(keys)) - np.repeat(first, np.diff(np.append(first, len(keys))))
    return out


def _unite(groups: np.ndarray, a: int, others: np.ndarray) -> None:
    names = np.append(groups[others], groups[a])
    groups[np.isin(groups, names)] = names.min()


def close_pairs(sizes: np.ndarray, bits: list[bytes], components: np.ndarray, blocks: np.ndarray, percent: int,
                limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the ``limit`` candidates of each component with the fewest differing bits.

    The third array tells of which pairs a component has more. A pair left out is
    of two such components.
    """
    names = np.unique(components, return_inverse=True)[1]
    count = np.zeros(len(components), np.int64)
    found, new, held = np.zeros((3, 0), np.int64), [], 0

    def closest() -> np.ndarray:
        pairs = np.concatenate([found, *new], axis=1)
        pairs = pairs[:, np.argsort(pairs[2], kind="stable")]
        rank = _ranks(np.stack([names[pairs[0]], names[pairs[1]]], axis=1).ravel()).reshape(-1, 2)
        return pairs[:, rank.min(axis=1) < limit]

    for a, b, differing in candidates(sizes, bits, components, blocks, percent):
        count[names[a]] += len(b)
        count += np.bincount(names[b], minlength=len(count))
        new.append(np.stack([np.full(len(b), a), b, differing]))
        held += len(b)
        if held > HELD_PAIRS:
            found, new, held = closest(), [], 0
    if new:
        found = closest()
    a, b, _ = found
    return a, b, np.maximum(count[names[a]], count[names[b]]) > limit


def tied_places(sizes: np.ndarray, bits: list[bytes], components: np.ndarray, blocks: np.ndarray,
                percent: int) -> np.ndarray:
    """For each place the first one that a chain of candidates leads to, or itself."""
    groups = np.arange(len(sizes))
    for a, b, _ in candidates(sizes, bits, components, blocks, percent, groups):
        _unite(groups, a, b)
    return groups


def joining_pairs(sets: list[np.ndarray], components: np.ndarray, blocks: np.ndarray,
                  percent: int) -> list[tuple[int, int]]:
    """Places of similar pairs that join those components that all similar pairs join, fewer than there are places."""
    sizes = np.array([len(s) for s in sets])
    groups = np.unique(components, return_inverse=True)[1]
    out = []
    for a, b, differing in candidates(sizes, [parity(s) for s in sets], groups, blocks, percent):
        b = b[np.argsort(differing, kind="stable")]
        # Of each group the closest first: one that is similar settles the others.
        take = 1
        while len(b):
            now = _ranks(groups[b]) < take
            asked, b, take = b[now], b[~now], take * 8
            values = np.concatenate([sets[i] for i in asked])
            at = np.minimum(np.searchsorted(sets[a], values), sizes[a] - 1)
            both = np.add.reduceat(sets[a][at] == values, np.cumsum(sizes[asked]) - sizes[asked], dtype=np.int64)
            fit = asked[both * 100 >= (sizes[a] + sizes[asked] - both) * percent]
            if len(fit):
                out += [(a, int(i)) for i in fit[_ranks(groups[fit]) == 0]]
                _unite(groups, a, fit)
                b = b[groups[b] != groups[a]]
    return out


def _sets(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for piece in words.pieces(batch, "text"):
            split = words.split(piece.column(1))
            hashes = words.word_hashes(split, fold_case=True)
            yield piece, [words.shingle_set(hashes[a:b], length) for a, b in zip(split.first[:-1], split.first[1:])]


def _long(values) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


def fingerprints(docs: DataFrame, length: int) -> DataFrame:
    """``doc_id, n_shingles, key_a, key_b, bits``: the size, a 128-bit hash and the parity bits of each set."""
    def rows(batches):
        for piece, sets in _sets(batches, length):
            yield pa.RecordBatch.from_arrays([
                piece.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                _long([words.mix(s, 1).sum(dtype=np.uint64) for s in sets]),
                _long([words.mix(s, 2).sum(dtype=np.uint64) for s in sets]),
                pa.array([parity(s) for s in sets], pa.binary()),
            ], ["doc_id", "n_shingles", "key_a", "key_b", "bits"])
    return docs.select("doc_id", "text").mapInArrow(
        rows, "doc_id long, n_shingles long, key_a long, key_b long, bits binary")


def index_rows(docs: DataFrame, length: int, percent: int) -> DataFrame:
    """``sig, doc_id``: the index entries of each document, of equal sets that a task meets those of the smallest one
    it has met (and of earlier ones that it took for the smallest)."""
    def rows(batches):
        least: dict[tuple[int, int], int] = {}
        for piece, sets in _sets(batches, length):
            if len(least) > COPIES:
                least.clear()
            entries = []
            for doc_id, s in zip(piece.column(0).to_pylist(), sets):
                same = int(words.mix(s, 1).sum(dtype=np.uint64)), int(words.mix(s, 2).sum(dtype=np.uint64))
                new = len(s) and doc_id < least.get(same, doc_id + 1)
                if new:
                    least[same] = doc_id
                entries.append(signatures(s, percent) if new else s[:0])
            ids = piece.column(0).take(pa.array(np.repeat(np.arange(len(sets)), [len(e) for e in entries])))
            yield pa.RecordBatch.from_arrays([_long(np.concatenate(entries)), ids], ["sig", "doc_id"])
    return docs.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(rows, "sig long, doc_id long")


def shingle_arrays(docs: DataFrame, length: int) -> DataFrame:
    """``doc_id, shingles``: the sets themselves."""
    def rows(batches):
        for piece, sets in _sets(batches, length):
            ends = np.cumsum([0] + [len(s) for s in sets])
            values = _long(np.concatenate(sets))
            yield pa.RecordBatch.from_arrays([
                piece.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)],
                ["doc_id", "shingles"])
    return docs.mapInArrow(rows, "doc_id long, shingles array<long>")


def _near(pairs: DataFrame, prints: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and parity bits leave similarity possible."""
    def side(name: str) -> DataFrame:
        return prints.select(F.col("doc_id").alias(name), F.col("n_shingles").alias(f"{name}_n"),
                             F.col("bits").alias(f"{name}_bits"))

    def rows(batches):
        for batch in batches:
            x, p, xn, pn, xb, pb = (batch.column(i).to_pylist() for i in range(6))
            fit = [differing_bits(a, b) * (100 + percent) <= (m + n) * (100 - percent)
                   for m, n, a, b in zip(xn, pn, xb, pb)]
            yield batch.select(["x", "p"]).filter(pa.array(fit, pa.bool_()))

    sized = pairs.join(side("x"), "x").join(side("p"), "p").where(
        F.col("x_n") * 100 >= F.col("p_n") * percent).where(F.col("p_n") * 100 >= F.col("x_n") * percent)
    return sized.select("x", "p", "x_n", "p_n", "x_bits", "p_bits").mapInArrow(rows, "x long, p long")


class _Verifier:
    """Exact checks of pairs, each once. Sets are made once for each document that comes up."""

    def __init__(self, docs: DataFrame, length: int, percent: int):
        self.docs = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
        self.length, self.percent = length, percent
        self.known: DataFrame | None = None
        self.checked: DataFrame | None = None

    def similar(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs that are similar and have not been asked for before."""
        # Entries propose the same pairs: each counts once before it is looked up.
        pairs = pairs.select("x", "p").distinct()
        if self.checked is not None:
            pairs = pairs.join(self.checked, ["x", "p"], "left_anti")
        pairs = kept(pairs, "asked")
        self.checked = pairs if self.checked is None else self.checked.unionByName(pairs)
        if pairs.isEmpty():
            return pairs
        sets = self.sets(pairs.select(F.col("x").alias("doc_id")).union(pairs.select("p")))
        side = {c: sets.select(F.col("doc_id").alias(c), F.col("shingles").alias(f"{c}_set")) for c in ("x", "p")}
        both = F.size(F.array_intersect("x_set", "p_set"))
        either = F.size("x_set") + F.size("p_set") - both
        fit = pairs.join(side["x"], "x").join(side["p"], "p").where(both * 100 >= either * self.percent)
        # Of rows that repeat an id with other texts several may be similar.
        return kept(fit.select("x", "p").distinct(), "similar")

    def sets(self, ids: DataFrame) -> DataFrame:
        """``doc_id, shingles`` of these documents."""
        # Written first, as Spark then knows how few they are and need not shuffle all texts to meet them.
        ids = kept(ids.distinct(), "ids")
        new = ids if self.known is None else kept(ids.join(self.known, "doc_id", "left_anti"), "new")
        if not new.isEmpty():
            made = kept(shingle_arrays(self.docs.join(new, "doc_id", "left_semi"), self.length), "shingles")
            self.known = made if self.known is None else self.known.unionByName(made)
        return self.known.join(ids, "doc_id", "left_semi")


@settled
def classes(docs: DataFrame, prints: DataFrame, length: int, percent: int) -> DataFrame:
    """``node, component``: the smallest document that links reach, of each document that has any.

    Equal sets hang from the smallest document of their class. Of the others the
    first document of each index entry is compared with all that share the entry,
    which connects most groups of near copies at a row per copy and entry. Entries
    whose documents are then in several components are searched for close pairs
    across them, block by block and by parity bits, inside the tasks. Each component
    proposes its few closest pairs, which are checked exactly. Where that left any
    out, the documents of close pairs that are still apart are put into groups, as far
    as such pairs reach, and a second search compares the sets within each group,
    inside the tasks too. No step has a row for each pair of a group's documents.
    """
    known = prints.where("doc_id IS NOT NULL AND n_shingles > 0")
    equal = known.groupBy("key_a", "key_b", "n_shingles").agg(F.min("doc_id").alias("p"))
    copies = kept(known.select("doc_id", "key_a", "key_b", "n_shingles")
                  .join(equal, ["key_a", "key_b", "n_shingles"]).select(F.col("doc_id").alias("x"), "p"), "classes")
    heads = copies.select(F.col("p").alias("doc_id")).distinct()
    together = Window.partitionBy("sig")
    entries = index_rows(docs, length, percent).select(
        "doc_id", F.min("doc_id").over(together).alias("pivot"), F.max("doc_id").over(together).alias("last"),
        F.count(F.lit(1)).over(together).alias("many"), F.bit_xor(F.xxhash64("doc_id")).over(together).alias("entry")
    ).where("pivot < last").drop("last")
    entries = kept(entries, "entries")
    free_shuffles(docs.sparkSession)
    prints = kept(known.join(heads, "doc_id", "left_semi").select("doc_id", "n_shingles", "bits"), "heads")
    verifier = _Verifier(docs, length, percent)

    # Documents that are no heads have no prints here and fall out in the join.
    pairs = entries.where("doc_id <> pivot").select(F.col("doc_id").alias("x"), F.col("pivot").alias("p")).distinct()
    edges = copies.where("x <> p").unionByName(verifier.similar(_near(pairs, prints, percent)))
    labels = components(edges, "x", "p")
    # Entries with the same documents are one from here on; those of two documents are settled.
    entries = kept(entries.where("many > 2").select("entry", "doc_id").distinct(), "groups")
    entries = entries.join(heads, "doc_id", "left_semi")
    rows = _unsettled(entries, labels)
    found = _close(rows, prints, percent, FIRST_PAIRS)
    more = verifier.similar(found.select("x", "p"))
    if not more.isEmpty():
        edges = edges.unionByName(more)
        labels = components(edges, "x", "p")
    back = found.where("more")
    if back.isEmpty():
        return labels
    # A pair of documents that was left out is of two components that have more.
    back = back.select("entry", F.explode(F.array("x_in", "p_in")).alias("component")).distinct()
    entries = rows.join(back, ["entry", "component"], "left_semi").select("entry", "doc_id")
    tied = _close(_unsettled(entries, labels), prints, percent, None).select("x", "p").distinct()
    if tied.isEmpty():
        return labels
    groups = components(tied, "x", "p").select(F.col("node").alias("doc_id"), F.col("component").alias("entry"))
    more = _joining(groups, labels, verifier.sets(groups.select("doc_id")), percent)
    return labels if more.isEmpty() else components(edges.unionByName(more), "x", "p")


def _labelled(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """``entry, doc_id, component``."""
    state = labels.select(F.col("node").alias("doc_id"), "component")
    return entries.join(state, "doc_id", "left").select(
        "entry", "doc_id", F.coalesce("component", "doc_id").alias("component"))


def _unsettled(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """``entry, doc_id, component, block, large``: the heads of entries with three or more, in several components."""
    rows = kept(_labelled(entries, labels), "labelled")
    groups = rows.groupBy("entry").agg(
        F.min("component").alias("a"), F.max("component").alias("b"), F.count(F.lit(1)).alias("last")
    ).where("a < b AND last > 2").select("entry", "last")
    # Documents of one component stand together, so that many blocks have no other.
    order = Window.partitionBy("entry").orderBy("component", "doc_id")
    block = F.floor((F.row_number().over(order) - 1) / BLOCK).cast("int")
    return kept(rows.join(groups, "entry").select(
        "entry", "doc_id", "component", block.alias("block"), (F.col("last") > BLOCK).alias("large")), "unsettled")


def _block_pairs(rows: DataFrame) -> DataFrame:
    """``entry, block, i, j``: which pairs of blocks of an entry each block takes part in; pairs of blocks that hold the
    same single component are left out."""
    blocks = kept(rows.groupBy("entry", "block").agg(F.min("component").alias("a"), F.max("component").alias("b")), "blocks")
    left = blocks.select("entry", F.col("block").alias("i"), F.col("a").alias("ia"), F.col("b").alias("ib"))
    right = blocks.select("entry", F.col("block").alias("j"), F.col("a").alias("ja"), F.col("b").alias("jb"))
    pairs = left.join(right, "entry").where("i <= j AND least(ia, ja) < greatest(ib, jb)")
    return pairs.select("entry", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the same ``entry, i, j``, the first columns, which stand together."""
    held: list[pa.RecordBatch] = []
    # The last run of a batch may go on in the next one: it waits.
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch]).combine_chunks().to_batches()[0]
        entry, i, j = (np.asarray(table.column(c)) for c in range(3))
        new = (np.diff(entry) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)
        bounds = [0, *(np.flatnonzero(new) + 1).tolist()]
        for a, b in zip(bounds, bounds[1:]):
            yield table.slice(a, b - a)
        held = [table.slice(bounds[-1])]
    yield from held


@settled
def _close(rows: DataFrame, prints: DataFrame, percent: int, limit: int | None) -> DataFrame:
    """``entry, x, p, x_in, p_in, more``: what ``close_pairs`` finds in each entry, by pairs of blocks of BLOCK documents,
    and the components of both. Without limit each document ``x`` that has any close pair stands once with the first
    one ``p`` that those lead to."""
    large = rows.where("large")
    spread = rows.where("NOT large").select("entry", "doc_id", "component", "block", F.lit(0).alias("i"), F.lit(0).alias("j"))
    if not large.isEmpty():
        spread = spread.unionByName(large.join(_block_pairs(large), ["entry", "block"]).select(spread.columns))
    rows = spread.join(prints, "doc_id").select("entry", "i", "j", "block", "doc_id", "component", "n_shingles", "bits")
    rows = rows.repartition("entry", "i", "j").sortWithinPartitions("entry", "i", "j", "doc_id")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches):
            entry, _, _, block, ids, component, sizes = (np.asarray(run.column(c)) for c in range(7))
            bits = run.column(7).to_pylist()
            if limit is None:
                p = tied_places(sizes, bits, component, block, percent)
                x = np.flatnonzero(p != np.arange(len(p)))
                p, more = p[x], np.zeros(len(x), bool)
            else:
                x, p, more = close_pairs(sizes, bits, component, block, percent, limit)
            if len(x):
                x, p = np.where(ids[x] > ids[p], (x, p), (p, x))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(entry[x]), pa.array(ids[x]), pa.array(ids[p]), pa.array(component[x]),
                     pa.array(component[p]), pa.array(more)], ["entry", "x", "p", "x_in", "p_in", "more"])

    return rows.mapInArrow(search, "entry long, x long, p long, x_in long, p_in long, more boolean")


@settled
def _joining(groups: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``x, p``: what ``joining_pairs`` finds in each group of ``entry, doc_id``, by pairs of blocks of SHINGLES shingles."""
    sets = kept(sets.where(F.size("shingles") > 0).distinct(), "sets")
    sizes = sets.groupBy("doc_id").agg(F.sum(F.size("shingles") + max(1, SHINGLES // BLOCK)).alias("size"))
    so_far = Window.partitionBy("entry").orderBy("component", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    block = F.floor(F.sum("size").over(so_far) / SHINGLES).cast("int")
    rows = kept(_labelled(groups, labels).join(sizes, "doc_id").select("entry", "doc_id", "component", block.alias("block")),
                "grouped")
    rows = rows.join(_block_pairs(rows), ["entry", "block"]).join(sets, "doc_id").select(
        "entry", "i", "j", "block", "doc_id", "component", "shingles")
    rows = rows.repartition("entry", "i", "j").sortWithinPartitions("entry", "i", "j", "doc_id")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches):
            block, ids, component = (np.asarray(run.column(c)) for c in (3, 4, 5))
            ends = np.cumsum(np.asarray(run.column(6).value_lengths()))
            values = np.asarray(run.column(6).flatten()).view(np.uint64)
            found = joining_pairs(np.split(values, ends[:-1]), component, block, percent)
            if found:
                x, p = ids[np.array(found)].T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.maximum(x, p)), pa.array(np.minimum(x, p))], ["x", "p"])

    return rows.mapInArrow(search, "x long, p long").distinct()


@settled
def near_duplicates(docs: DataFrame, length: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs`` (``doc_id``, ``text``).

    Words lose the case of A-Z; a set holds the distinct runs of ``length`` words,
    of a shorter text the whole, of an empty or null text nothing. Two documents
    link when 100 times the shared shingles reach ``percent`` times all of both;
    ``component_id`` is the smallest ``doc_id`` that links reach, itself included.
    A document without shingles is alone. Rows that repeat a ``doc_id`` are one
    document with the links of all of them; rows without ``doc_id`` have sizes but
    take no part in links, their component is null. Further columns are not read.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must lie in 1 to 100")
    prints = kept(fingerprints(docs, length), "prints")
    labels = classes(docs, prints, length, percent)
    sizes = prints.select("doc_id", "n_shingles")
    return sizes.join(labels, sizes.doc_id == labels.node, "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
