"""Top-k: proof and work of the index, against plain products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from dealscope.llm import exact_topk


def plain(ids, vectors, query, query_id, k):
    scores = vectors @ query
    order = [i for i in np.lexsort((ids, -scores)) if ids[i] != query_id][:k]
    return ids[order].tolist(), scores[order].tolist()


@pytest.mark.parametrize("scale", [256, 2**27])
def test_index_finds_the_best_at_every_size(scale):
    dice = np.random.default_rng(4)
    for n, dims in ((1, 3), (4, 2), (6, 5), (300, 8), (3000, 16)):
        vectors = np.floor(dice.normal(size=(n, dims)) * scale).astype(np.int64)
        vectors[n // 2:] = vectors[:n - n // 2]
        ids = dice.permutation(n).astype(np.int64)
        index = exact_topk.Index(ids, vectors)
        for place in range(0, n, max(1, n // 20)):
            want = plain(ids, vectors, vectors[place], ids[place], 5)
            bar = want[1][-1] if len(want[1]) == 5 else None
            for given in (None, bar, None if bar is None else bar - 3 * abs(bar)):
                got = index.top(vectors[place], int(ids[place]), 5, given)
                assert (got.ids.tolist(), got.scores.tolist()) == want


def test_the_index_stops_on_proof_and_scores_few(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir.replace('sf0.01', 'sf0.1')}/embeddings.parquet").select(
        "vec_id", exact_topk.scaled(F.col("embedding"), 256.0).alias("v")).where("v IS NOT NULL").collect()
    ids = np.array([r.vec_id for r in rows])
    vectors = np.array([r.v for r in rows])
    seed = np.random.default_rng(1).choice(len(ids), min(len(ids) // 2, exact_topk.SEED), replace=False)
    index = exact_topk.Index(ids, vectors)
    found = []
    for place in np.flatnonzero(ids % 50 == 0):
        bar = plain(ids[seed], vectors[seed], vectors[place], ids[place], 5)[1][-1]
        found.append(index.top(vectors[place], int(ids[place]), 5, bar))
    assert np.mean([f.processed for f in found]) < 0.95
    assert np.mean([f.scored for f in found]) < 0.1


def test_blocks_and_chunks(spark, monkeypatch):
    for name, value in (("BLOCK", 40), ("CHUNK", 7), ("SEED", 20)):
        monkeypatch.setattr(exact_topk, name, value)
    dice = np.random.default_rng(9)
    vectors = np.floor(dice.normal(size=(300, 6)) * 20).astype(np.int64)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(i, vectors[i].tolist()) for i in range(5)]
    frame = spark.createDataFrame(rows, "vec_id long, vector array<long>").withColumn("bar", F.lit(1))
    got = exact_topk.top_k(frame, frame.where("vec_id % 6 = 0"), 5).orderBy("query_id", "rank").collect()
    ids, all_vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    want = [(q, rank + 1, i, s) for q in range(0, 300, 6) for rank, (i, s) in enumerate(
        zip(*plain(ids, all_vectors, vectors[q], q, 5)))]
    assert [tuple(r) for r in got] == want
