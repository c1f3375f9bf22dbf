"""Nulls, empty and long texts, repeated rows, clashing names, empty tables; results against SQL."""

import pytest

import corpus_pipeline
from dealscope.llm import (exact_topk, langid, license_scan, mixing, ngram_join, packing, quality_rules, sharding,
                           substring_dedup, toxicity)
from dealscope.llm.oracle import ORACLE
from dealscope.llm.queries import QUERIES
from tests.compare import assert_same, duck


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 0, 1), (None, 1, 1), (8, None, None)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "sharding": lambda d, l: sharding.document_shards(d, 8),
    "near_duplicates": lambda d, l: ngram_join.near_duplicates(d, 3, 90),
    "quality": lambda d, l: quality_rules.document_quality(d),
    "substrings": lambda d, l: substring_dedup.substring_digest(d),
    "drop_repeats": lambda d, l: substring_dedup.drop_repeats(d),
    "mixing": lambda d, l: mixing.document_mix(d),
    "languages": lambda d, l: langid.document_languages(d),
    "toxicity": lambda d, l: toxicity.document_toxicity(d, l),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_each_row(name, odd_docs, labels):
    assert len(OPERATORS[name](odd_docs, labels).collect()) == odd_docs.count()


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(name, no_docs, labels):
    assert OPERATORS[name](no_docs, labels.where("false")).collect() == []


def test_defined_results(odd_docs, labels):
    near = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(odd_docs, 3, 90).collect()}
    assert near[2][1] == 1 and near[3] == near[5] == (0, 3) or near[3] == (0, 3)
    assert near[7] == (1, 6) and near[None] == (1, None) and near[4] == (0, 4)
    cut = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.substring_digest(odd_docs).collect()}
    assert cut[1] == (30_000, 0) and cut[2] == (30_000, 30_000) and cut[4] == (0, 0)
    shards = {r.doc_id: r for r in sharding.document_shards(odd_docs, 8).collect()}
    assert shards[1].shard == shards[2].shard and shards[4].size == 1 and shards[4].text_crc32 is None
    lang = {r.doc_id: (r.lang_pred, r.score) for r in langid.document_languages(odd_docs).collect()}
    assert lang[3] == lang[4] == lang[5] == ("und", 0.0)
    packed = packing.document_packing(odd_docs).where("doc_id = 1").collect()
    assert sum(r.tokens for r in packed) == 30_000


def test_license_units(spark):
    rows = [(1, "Some text here.\nReleased under the MIT License. More text."), (2, "All rights  RESERVED"), (3, None),
            (4, ""), (5, "nothing of the kind in these words")]
    got = {(r.doc_id, r.scope, r.license) for r in license_scan.license_scan(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, "sentence", "MIT"), (2, "text", "Proprietary")}


def test_top_k_ties_and_unfit_vectors(spark):
    rows = [(0, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [float("nan"), 0.1]), (4, None), (5, [None, 0.1]),
            (6, []), (7, [-1.0, -1.0]), (None, [1.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in exact_topk.embedding_neighbours(frame).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 32768), (0, 2, 2, 32768), (0, 3, 7, -65536)]
    assert exact_topk.embedding_neighbours(frame.where("false")).collect() == []


def test_water_filling_caps(spark):
    rows = [(i, "w " * 10, s) for i, s in enumerate(["a"] * 2 + ["b"] * 4 + ["c"] * 1 + [None] * 50)]
    got = mixing.document_mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    target = {r.source_size: r.target for r in got}
    assert target[10] == 30.0 and sum(target.values()) == pytest.approx(570.0)
    assert all(r.taken <= 3 * r.size for r in got)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf_dir, name):
    assert assert_same(QUERIES[name](spark, sf_dir), duck(sf_dir), ORACLE[name]) > 0


def test_pipeline_stages_keep_the_columns(spark, odd_docs, sf_dir):
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        docs = out
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() > 0
