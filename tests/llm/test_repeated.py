"""Ids that come several times, with the same text or with others, and rows at the edge of a cap."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dealscope.llm import mixing, packing, quality_rules, sharding, substring_dedup, toxicity
from tests.llm.test_brute_force import brute_repeats

SCHEMA = "doc_id long, text string"


def plain(name, count):
    return " ".join(f"{name}{i}" for i in range(count))


def test_an_unrelated_text_of_a_repeated_id_stays(spark):
    docs = spark.createDataFrame([(1, plain("a", 60)), (2, plain("a", 60)), (2, plain("b", 60)), (2, plain("a", 60))], SCHEMA)
    got = sorted((r.doc_id, r.text) for r in substring_dedup.drop_repeats(docs.withColumn("variant", F.lit("x"))).collect())
    assert [(i, t.split()) for i, t in got] == [(1, plain("a", 60).split()), (2, []), (2, []), (2, plain("b", 60).split())]


def test_repeated_ids_against_plain_windows(spark):
    dice = random.Random(8)
    passages = [plain(f"p{i}_", dice.randint(8, 30)) for i in range(12)]
    rows = [(i // 2, " ".join(dice.choice(passages) + f" own{i}_{j}" for j in range(4))) for i in range(80)]
    # A row of its own id for each, so that the plain version can tell them apart.
    first = {}
    for i, text in rows:
        own = text.split()
        for j in range(len(own) - 9):
            key = tuple(own[j:j + 10])
            first[key] = min(i, first.get(key, i))
    want = []
    for i, text in rows:
        own, gone = text.split(), set()
        for j in range(len(own) - 9):
            if first[tuple(own[j:j + 10])] < i:
                gone |= set(range(j, j + 10))
        want.append((i, len(own), len(gone)))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = [(r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.substring_digest(docs, 10, 4).collect()]
    assert sorted(got) == sorted(want) and any(n for *_, n in got)


def test_no_row_comes_more_often_than_the_cap(spark):
    rows = [(i, "", "a") for i in range(200)] + [(200, "w " * 10, "a")] + [(300 + i, "w " * 50, "b") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    count = Counter(r.doc_id for r in mixing.repeated(docs).collect())
    assert max(count.values()) <= 3 and count[200] == 3


def test_words_of_another_script_need_no_latin_stop_words(spark):
    texts = {1: " ".join("слово" + "абвгдежзик"[i % 10] * (1 + i // 10 % 4) + "лмнопрстуф"[i // 40] for i in range(200)),
             2: plain("word", 200), 3: plain("word", 197) + " the of and to in a"}
    got = {r.doc_id: r for r in quality_rules.judged(spark.createDataFrame(list(texts.items()), SCHEMA)).collect()}
    assert got[1].kept and got[1].n_latin_words == 0 and got[2].failed == ["stop_words"] and got[3].kept


def test_the_fit_takes_one_text_of_an_id(spark):
    rows = [(i, f"{word} text of {i}") for i in range(40) for word in ("one", "another", "third")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    runs = [{tuple(r) for r in toxicity.training_rows(spark.createDataFrame(part, SCHEMA).repartition(3), labels).collect()}
            for part in (rows, rows[::-1])]
    assert runs[0] == runs[1] and len(runs[0]) == len({r[0] for r in runs[0]})


def test_pipeline_keeps_one_of_equal_rows(spark, sf_dir):
    rows = [(1, plain("a", 80)), (1, plain("a", 80)), (1, plain("b", 80)), (2, plain("a", 80)), (None, "x"), (None, "x")]
    docs = spark.createDataFrame([(*r, "en", "s", 9) for r in rows], SCHEMA + ", lang string, source string, n_chars int")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(
        [(1, plain("a", 80)), (1, plain("b", 80)), (None, "x"), (None, "x")])


def test_pipeline_over_an_empty_table_and_repeated_rows(spark, odd_docs, sf_dir):
    for docs in (odd_docs.where("false"), odd_docs.unionByName(odd_docs)):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf_dir)
        assert docs.count() >= 0


def best_fit(lengths, sizes):
    """Plain best fit over several sizes: the tightest bin that fits, else a new one of the size of least waste."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fitting = [i for i, room in enumerate(rooms) if room >= n]
        if fitting:
            rooms[min(fitting, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(max(sizes) - n)
    return len(rooms)


def test_packing_keeps_every_word_within_the_lengths(spark):
    dice = random.Random(3)
    rows = [(i, "w " * dice.choice([0, 1, 5, 40, 300, 900, 2500, 9000])) for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = packing.document_packing(docs).collect()
    assert sum(r.tokens for r in got) == sum(t.count("w") for _, t in rows)


def test_sharding_of_repeated_ids(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (2, "a")], SCHEMA)
    got = sharding.document_shards(docs, 8).collect()
    assert len(got) == 4 and len({r.shard for r in got if r.text_crc32 == 0xE8B7BE43}) == 1
