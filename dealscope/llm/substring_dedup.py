"""Removal of long repeats, by seeds and extension.

Seeds are winnowed anchors: of the ``seed_words``-word runs in each window of
``min_words`` words the one with the least hash (the leftmost, if equal). Equal
windows have the same anchor at the same place, so documents that share a window
meet at its anchor. Around an anchor lies its reach: the stretch of all windows
it was chosen for. Documents are joined on anchors in two steps.

1. Extension as a whole: occurrences with the same anchor and reach repeat the
   first of them, left and right to the ends of the reach. Insides of copies and
   of shared passages end here, at one row per occurrence; the first occurrence
   stands for its kind from now on.
2. Extension word by word, only for anchors with several reaches (the ends of
   passages, and edits): each window of a reach, found by its hash, is matched
   with the smallest document that has it.

A document's repeats are the windows that a smaller document has; touching ones
join to maximal repeats. No pairs of documents are listed, so a passage that a
third of all documents share costs a row per occurrence and window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealscope.llm import words
from dealscope.llm.tables import kept, settled


def anchors(hashes: np.ndarray, min_words: int, seed_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each chosen anchor the hash, its first window and how many windows in a row chose it."""
    if len(hashes) < min_words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    seeds = words.run_hashes(hashes, seed_words)
    width = min_words - seed_words + 1
    chosen = np.lib.stride_tricks.sliding_window_view(seeds, width).argmin(axis=1) + np.arange(len(seeds) - width + 1)
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    return seeds[chosen[first]], first, np.diff(np.append(first, len(chosen)))


def _long(values) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def occurrences(docs: DataFrame, min_words: int, seed_words: int) -> DataFrame:
    """``anchor, reach, doc_id, variant, at, windows``: each anchor, a hash of its reach, and its windows."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.pieces(batch, "text"):
                split = words.split(piece.column(2))
                hashes = words.word_hashes(split)
                found = []
                for a, b in zip(split.first[:-1], split.first[1:]):
                    seed, at, windows = anchors(hashes[a:b], min_words, seed_words)
                    # The anchor's place in the reach belongs to the reach: equal stretches agree in it.
                    reach = words.span_hashes(hashes[a:b], at, at + windows + min_words - 1, words.SECOND_BASE)
                    found.append((seed, reach, at, windows))
                count = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
                seed, reach, at, windows = (np.concatenate([f[i] for f in found]) for i in range(4))
                yield pa.RecordBatch.from_arrays([
                    _long(seed), _long(reach), *[piece.column(c).take(pa.array(count)) for c in (0, 1)],
                    pa.array(at, pa.int32()), pa.array(windows, pa.int32()),
                ], ["anchor", "reach", "doc_id", "variant", "at", "windows"])
    return docs.where("doc_id IS NOT NULL").select("doc_id", "variant", "text").mapInArrow(
        rows, "anchor long, reach long, doc_id long, variant long, at int, windows int")


def window_rows(docs: DataFrame, places: DataFrame, min_words: int) -> DataFrame:
    """``anchor, window, doc_id, variant, at``: a hash of each window of the given occurrences."""
    # Of one text, however many rows repeat it.
    per_doc = places.groupBy("doc_id", "variant").agg(F.collect_set(F.struct("anchor", "at", "windows")).alias("places"))

    def rows(batches):
        for batch in batches:
            for piece in words.pieces(batch, "text"):
                split = words.split(piece.column(2))
                hashes = words.word_hashes(split)
                lists = piece.column(3)
                ends = np.asarray(lists.offsets)
                flat = lists.values
                seed, at, windows = (np.asarray(flat.field(i)) for i in range(3))
                out = []
                for i, (a, b) in enumerate(zip(split.first[:-1], split.first[1:])):
                    mine = slice(ends[i], ends[i + 1])
                    reps = windows[mine].astype(np.int64)
                    start = np.repeat(at[mine].astype(np.int64), reps)
                    start += np.arange(len(start)) - np.repeat(np.cumsum(reps) - reps, reps)
                    out.append((np.repeat(seed[mine], reps), words.span_hashes(hashes[a:b], start, start + min_words, words.SECOND_BASE),
                                start))
                owner = pa.array(np.repeat(np.arange(len(out)), [len(o[2]) for o in out]))
                names, window, start = (np.concatenate([o[i] for o in out]) for i in range(3))
                yield pa.RecordBatch.from_arrays([
                    _long(names), _long(window), *[piece.column(c).take(owner) for c in (0, 1)],
                    pa.array(start, pa.int32())], ["anchor", "window", "doc_id", "variant", "at"])
    joined = docs.select("doc_id", "variant", "text").join(per_doc, ["doc_id", "variant"]).select(
        "doc_id", "variant", "text", "places")
    return joined.mapInArrow(rows, "anchor long, window long, doc_id long, variant long, at int")


@settled
def repeats(docs: DataFrame, min_words: int, seed_words: int) -> DataFrame:
    """``doc_id, variant, at, windows``: stretches of windows that a document with a smaller id has too."""
    found = kept(occurrences(docs, min_words, seed_words), "anchors")
    kinds = kept(found.groupBy("anchor", "reach").agg(F.min("doc_id").alias("head"), F.max("doc_id").alias("last")),
                 "reaches")
    whole = found.join(kinds.where("head < last").select("anchor", "reach", "head"), ["anchor", "reach"]).where(
        "doc_id > head").select("doc_id", "variant", "at", "windows")
    # Anchors with several reaches and documents.
    mixed = kinds.groupBy("anchor").agg(
        F.min("reach").alias("a"), F.max("reach").alias("b"), F.min("head").alias("c"), F.max("last").alias("d")
    ).where("a < b AND c < d").select("anchor")
    heads = kinds.join(mixed, "anchor", "left_semi").select("anchor", "reach", F.col("head").alias("doc_id"))
    places = found.join(heads, ["anchor", "reach", "doc_id"], "left_semi").select(
        "doc_id", "variant", "anchor", "at", "windows")
    single = kept(window_rows(docs.where("doc_id IS NOT NULL"), places, min_words), "windows")
    firsts = single.groupBy("anchor", "window").agg(F.min("doc_id").alias("head"), F.max("doc_id").alias("last"))
    matched = single.join(firsts.where("head < last").select("anchor", "window", "head"), ["anchor", "window"]).where(
        "doc_id > head").select("doc_id", "variant", "at", F.lit(1).alias("windows"))
    return whole.union(matched)


def with_variants(docs: DataFrame) -> DataFrame:
    """``docs`` and ``variant``, a hash of the text for ids that come with several texts and 0 for all others."""
    text = F.xxhash64("text")
    several = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(text).alias("a"), F.max(text).alias("b")).where(
        "a < b").select("doc_id", F.lit(True).alias("_several"))
    several = kept(several, "several-texts")
    if several.isEmpty():
        return docs.withColumn("variant", F.lit(0).cast("long"))
    return docs.join(several, "doc_id", "left").withColumn(
        "variant", F.when(F.col("_several"), text).otherwise(F.lit(0).cast("long"))).drop("_several")


def with_repeats(docs: DataFrame, min_words: int = 50, seed_words: int = 16) -> DataFrame:
    """``docs`` and ``repeats``, an array of (at, windows), null without any."""
    if not 0 < seed_words <= min_words:
        raise ValueError("seed_words must lie in 1 to min_words")
    docs = with_variants(docs)
    marks = repeats(docs, min_words, seed_words).groupBy("doc_id", "variant").agg(
        F.collect_set(F.struct("at", "windows")).alias("repeats"))
    return docs.join(marks, ["doc_id", "variant"], "left").drop("variant")


def _removed(lists: pa.Array, first: np.ndarray, min_words: int) -> tuple[np.ndarray, list[bool]]:
    """Which words of a batch are covered by repeats; which texts have any."""
    size = int(first[-1])
    steps = np.zeros(size + 1, np.int64)
    touched = []
    for i, marks in enumerate(lists.to_pylist()):
        a, b = int(first[i]), int(first[i + 1])
        hit = False
        for mark in marks or ():
            start, end = a + mark["at"], a + mark["at"] + mark["windows"] + min_words - 1
            if end <= b:
                steps[start] += 1
                steps[end] -= 1
                hit = True
        touched.append(hit)
    return np.cumsum(steps)[:size] > 0, touched


def substring_digest(docs: DataFrame, min_words: int = 50, seed_words: int = 16) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for each row of ``docs``, see ``drop_repeats``."""
    def rows(batches):
        for batch in batches:
            for piece in words.pieces(batch, "text"):
                split = words.split(piece.column(1))
                gone, _ = _removed(piece.column(2), split.first, min_words)
                raw = split.data.tobytes()
                digest, removed = [], []
                for a, b in zip(split.first[:-1], split.first[1:]):
                    own = gone[a:b]
                    keep = np.flatnonzero(~own) + a
                    digest.append(hashlib.sha256(b" ".join(
                        [raw[s:e] for s, e in zip(split.start[keep].tolist(), split.end[keep].tolist())])).hexdigest())
                    removed.append(int(own.sum()))
                yield pa.RecordBatch.from_arrays([
                    piece.column(0), pa.array(np.diff(split.first), pa.int64()), pa.array(removed, pa.int64()),
                    pa.array(digest, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])
    marked = with_repeats(docs.select("doc_id", "text"), min_words, seed_words).select("doc_id", "text", "repeats")
    return marked.mapInArrow(rows, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def drop_repeats(docs: DataFrame, min_words: int = 50, seed_words: int = 16,
                 removed_name: str = "n_removed") -> DataFrame:
    """``docs`` with their repeats taken out of ``text``, ``n_chars`` (if there) counted anew, and in
    ``removed_name`` the number of words taken.

    A word goes if a window of ``min_words`` consecutive words covers it that also
    starts in a document with a smaller ``doc_id``; windows are judged on the texts
    as they came. Repeats within one document stay. Other words keep the space
    around them. Null and short texts pass unchanged, so do rows without
    ``doc_id``; rows that repeat a ``doc_id``, with the same text or another, don't
    repeat each other, but each is held against smaller ids by its own text. Hashes of 64 bits stand for anchors and, beside them, for reaches
    and windows: 128 bits decide that two windows are equal.
    """
    names = docs.columns
    rest = F.struct(*[c for c in names if c != "text"]).alias("_rest")

    def rows(batches):
        for batch in batches:
            for piece in words.pieces(batch, "text"):
                column = piece.column(piece.schema.get_field_index("text"))
                split = words.split(column)
                gone, touched = _removed(piece.column(piece.schema.get_field_index("repeats")), split.first, min_words)
                raw = split.data.tobytes()
                texts, removed = [], []
                for i, hit in enumerate(touched):
                    a, b = int(split.first[i]), int(split.first[i + 1])
                    if not hit:
                        texts.append(column[i].as_py())
                        removed.append(0)
                        continue
                    own = gone[a:b]
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
                    at, parts = int(split.offsets[i]), []
                    for s, e in zip(edges[::2].tolist(), edges[1::2].tolist()):
                        parts.append(raw[at:int(split.start[a + s])])
                        at = int(split.start[a + e]) if a + e < b else int(split.offsets[i + 1])
                    parts.append(raw[at:int(split.offsets[i + 1])])
                    texts.append(b"".join(parts).decode("utf-8", "replace"))
                    removed.append(int(own.sum()))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(piece.schema.get_field_index("_rest")), pa.array(texts, pa.string()),
                     pa.array(removed, pa.int64())], ["_rest", "text", "n_removed"])
    marked = with_repeats(docs.select("doc_id", "text", rest), min_words, seed_words)
    schema = marked.select("_rest", "text", F.lit(0).cast("long").alias("n_removed")).schema
    out = marked.mapInArrow(rows, schema)
    fields = {c: F.col("_rest").getField(c) for c in names if c != "text"} | {"text": F.col("text")}
    if "n_chars" in names:
        fields["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[fields[c].alias(c) for c in names], F.col("n_removed").alias(removed_name))
