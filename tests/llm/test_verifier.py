"""Exact checks of candidate pairs: each pair once, and without a shuffle of all texts for a few documents."""

import pytest
from pyspark.sql import functions as F

from dealscope.llm import ngram_join


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(i, "a b c d e f g h i j " + "k" * (i % 3)) for i in range(300)], "doc_id long, text string")


def test_a_pair_is_checked_once(spark, docs):
    verifier = ngram_join._Verifier(docs, 3, 80)
    pairs = spark.createDataFrame([(3, 0), (4, 0), (6, 0)], "x long, p long")
    assert {(r.x, r.p) for r in verifier.similar(pairs).collect()} == {(3, 0), (4, 0), (6, 0)}
    again = pairs.union(spark.createDataFrame([(9, 0), (9, 0)], "x long, p long"))
    assert [(r.x, r.p) for r in verifier.similar(again).collect()] == [(9, 0)]


def test_texts_are_not_shuffled_for_few_documents(spark, docs, monkeypatch):
    made = []
    write = ngram_join.kept

    def kept(rows, label):
        if label == "shingles":
            made.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(rows, label)
    monkeypatch.setattr(ngram_join, "kept", kept)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        verifier = ngram_join._Verifier(docs, 3, 80)
        # Many rows, as entries propose a pair again and again, of few documents.
        found = spark.range(300_000).select((F.col("id") % 5 + 1).alias("x"), F.lit(0).cast("long").alias("p"))
        assert verifier.similar(found).count() == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(made) == 1 and "BroadcastHashJoin" in made[0] and "SortMergeJoin" not in made[0]


def test_further_rounds_read_components_held_back_only(spark, monkeypatch):
    """Three of four documents apart have pairs left over after the first round: the second doesn't read the fourth."""
    rounds = []

    def close(rows, prints, percent, limit):
        own = {r.doc_id: r.component for r in rows.collect()}
        rounds.append(set(own))
        entry = rows.first().entry
        found = [(entry, x, 0, own[x], own[0], True) for x in (1, 2)] if limit == ngram_join.FIRST_PAIRS else []
        return spark.createDataFrame(found, "entry long, x long, p long, x_in long, p_in long, more boolean")
    monkeypatch.setattr(ngram_join, "_close", close)
    shared = " ".join(f"s{i}" for i in range(40))
    rows = [(i, shared + " " + " ".join(f"d{i}x{j}" for j in range(6))) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs, 5, 80).collect()}
    assert got == {i: i for i in range(4)}
    assert rounds == [{0, 1, 2, 3}, {0, 1, 2}]
