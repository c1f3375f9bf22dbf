"""Exact top-k inner products over an impact-ordered index, score at a time.

Candidates are dealt out in blocks, queries in chunks, and each block meets each
chunk in one task of bounded size. A block's index cuts every dimension into
posting segments of candidates with about the same value. For a query a segment has
a quantised impact: the most its values can lift the product above the dimension's
worst segment. Segments are processed by descending impact, adding it up for their
candidates. What a candidate can reach at most is that sum and the largest impacts
not yet processed. The bar it must reach is proven: the k-th best product with the
SEED candidates that every query is compared with first. When few candidates can
still reach the bar, these are scored exactly and the rest of the segments is left.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealscope.llm.tables import kept

BLOCK = 16384
CHUNK = 4096
#: Candidates that set the bars.
SEED = 4096
SEGMENTS = 32
#: Looks at the bounds on the way through all segments, and the share of a block that may be scored exactly.
LOOKS = 24
RESCORED_SHARE = 1 / 16
#: Sums of numbers up to this are exact in floating point.
_EXACT = 2.0**53


class Found(NamedTuple):
    """The best candidates of a block with their products, and which shares of the segments were processed and of the
    candidates scored for that."""

    ids: np.ndarray
    scores: np.ndarray
    processed: float
    scored: float


class Index:
    """Posting segments of one block: per dimension, SEGMENTS slices of the candidates in order of value."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        n, self.dims = self.vectors.shape
        by_value = np.argsort(self.vectors, axis=0, kind="stable").astype(np.int32)
        bounds = np.unique(np.linspace(0, n, min(SEGMENTS, n) + 1).astype(int))
        self.postings = [by_value[a:b, d] for d in range(self.dims) for a, b in zip(bounds, bounds[1:])]
        self.size = np.tile(np.diff(bounds), self.dims)
        ordered = np.take_along_axis(self.vectors, by_value, axis=0)
        self.low, self.high = ordered[bounds[:-1]].T, ordered[bounds[1:] - 1].T
        self.most = float(np.abs(self.vectors).max(initial=0))
        self.floats = self.vectors.astype(np.float64)

    def products(self, query: np.ndarray, places: np.ndarray) -> np.ndarray:
        if self.most * float(np.abs(query).sum()) < _EXACT:
            return (self.floats[places] @ query.astype(np.float64)).astype(np.int64)
        return self.vectors[places] @ query

    def top(self, query: np.ndarray, query_id: int, k: int, bar: int | None = None) -> Found:
        """The k best candidates other than ``query_id``, ties to the smaller id; some that ``bar``, a product that k
        candidates are known to reach, rules out may be missing."""
        possible, processed = self._possible(query, query_id, k, bar)
        exact = self.products(query, possible)
        best = np.lexsort((self.ids[possible], -exact))[:k]
        return Found(self.ids[possible[best]], exact[best], processed, len(possible) / max(1, len(self.ids)))

    def _possible(self, query: np.ndarray, query_id: int, k: int, bar: int | None) -> tuple[np.ndarray, float]:
        others = self.ids != query_id
        n = len(self.ids)
        if bar is None or n <= k:
            return np.flatnonzero(others), 0.0
        q = query[:, None]
        reach = np.where(q >= 0, q * self.high, q * self.low)
        worst = reach.min(axis=1)
        impact = (reach - worst[:, None]).ravel()
        lacking = bar - int(worst.sum())
        sequence = np.argsort(-impact, kind="stable")
        dimension = sequence // reach.shape[1]
        light = float(np.abs(reach).sum()) < _EXACT
        gained = np.zeros(n, np.float64 if light else np.int64)
        for part in np.array_split(np.arange(len(sequence)), LOOKS):
            own = sequence[part]
            places = np.concatenate([self.postings[i] for i in own.tolist()])
            gains = np.repeat(impact[own], self.size[own])
            if light:
                gained += np.bincount(places, gains, n)
            else:
                np.add.at(gained, places, gains)
            ahead = np.zeros(self.dims, np.int64)
            after = int(part[-1]) + 1
            np.maximum.at(ahead, dimension[after:], impact[sequence[after:]])
            hopeful = np.flatnonzero((gained >= lacking - int(ahead.sum())) & others)
            if len(hopeful) <= max(4 * k, n * RESCORED_SHARE):
                break
        return hopeful, after / len(sequence)


def scaled(vector: Column, factor: float) -> Column:
    """floor(factor * x) of each component as a double; null for vectors that are null, empty or hold a null or
    non-finite component."""
    parts = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(factor)).cast("long"))
    whole = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))), F.lit(False)))
    return F.when(whole & (F.size(vector) > 0), parts)


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query its ``k`` largest inner products with ``vectors``.

    Both hold ``vec_id`` and ``vector``, an array of longs; nulls take no part. A
    vector isn't compared with queries of its own id. Ties go to the smaller id;
    fewer candidates give fewer rows. Shorter vectors count as filled up with zeros.
    Products are exact as long as they stay below 2^62. Repeated rows are candidates
    of their own; repeated query ids are asked once, with the least of their vectors.
    """
    vectors = kept(vectors.where("vec_id IS NOT NULL AND vector IS NOT NULL").select("vec_id", "vector"), "vectors")
    queries = kept(queries.where("vec_id IS NOT NULL AND vector IS NOT NULL").groupBy("vec_id").agg(
        F.min("vector").alias("vector")), "queries")
    n, dims = vectors.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    m, query_dims = queries.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    blocks, chunks = max(1, math.ceil(n / BLOCK)), max(1, math.ceil(m / CHUNK))
    width = max(dims or 0, query_dims or 0)

    def matrix(vectors_: pd.Series) -> np.ndarray:
        out = np.zeros((len(vectors_), width), np.int64)
        for i, v in enumerate(vectors_):
            out[i, :len(v)] = v
        return out

    def met(candidates: DataFrame, asked: DataFrame, parts: int, answer: Callable, schema: str) -> DataFrame:
        """``answer`` of each block of candidates and each chunk of queries, in a task of their own."""
        def dealt(rows: DataFrame, own: str, groups: int, other: str, others: int) -> DataFrame:
            # Row numbers spread equal rows evenly over the groups; a row has one of its own before it is repeated.
            rows = rows.withColumn(own, F.pmod(F.monotonically_increasing_id(), F.lit(groups)))
            rows = rows.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))))
            return rows.repartition(parts * chunks, "block", "chunk").groupBy("block", "chunk")

        return dealt(candidates, "block", parts, "chunk", chunks).cogroup(
            dealt(asked, "chunk", chunks, "block", parts)).applyInPandas(answer, schema)

    def bars(candidates: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = asked[["vec_id", "vector"]].assign(bar=pd.array([None] * len(asked), dtype="Int64"))
        if len(candidates) and len(asked):
            index = Index(candidates["vec_id"].to_numpy(np.int64), matrix(candidates["vector"]))
            best = [index.top(q, i, k).scores for i, q in zip(asked["vec_id"].tolist(), matrix(asked["vector"]))]
            found["bar"] = pd.array([int(b[-1]) if len(b) == k else None for b in best], dtype="Int64")
        return found

    def search(candidates: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found: list[pd.DataFrame] = []
        if len(candidates) and len(asked):
            index = Index(candidates["vec_id"].to_numpy(np.int64), matrix(candidates["vector"]))
            known = [None if pd.isna(b) else int(b) for b in asked["bar"]]
            for query_id, query, bar in zip(asked["vec_id"].tolist(), matrix(asked["vector"]), known):
                best = index.top(query, query_id, k, bar)
                found.append(pd.DataFrame({"query_id": query_id, "vec_id": best.ids, "score": best.scores}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")

    seed = kept(vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SEED), "seed")
    queries = kept(met(seed, queries, 1, bars, "vec_id long, vector array<long>, bar long"), "bars")
    found = met(vectors, queries, blocks, search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def embedding_neighbours(embeddings: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """The ``k`` best of every ``every``-th id among all other embeddings, components as floor(256 x).

    Embeddings that are null, empty or hold a null or non-finite component take no part, nor do rows without ``vec_id``.
    """
    vectors = embeddings.select("vec_id", scaled(F.col("embedding"), 256.0).alias("vector"))
    return top_k(vectors, vectors.where(F.col("vec_id") % every == 0), k)
