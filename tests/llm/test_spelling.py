"""Spelling variants: the acceptors against all pairs, the query against a plain version."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from dealscope.llm import spelling


def near(u, v):
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1:] == u for i in range(len(v)))


def test_composition_finds_each_pair_once():
    dice = random.Random(3)
    for turn in range(1500):
        letters, k = "ab" if turn % 2 else "abc", dice.randint(0, 4)
        shorts, longs = (sorted({"".join(dice.choice(letters) for _ in range(m)) for _ in range(dice.randint(1, 9))})
                         for m in (k, k + 1))
        among, between = spelling.near_pairs(shorts, longs, True)
        pairs = [sorted((i + s, j + s) for i, j, n in runs for s in range(n)) for runs in (among, between)]
        assert pairs[0] == [(i, j) for j in range(len(shorts)) for i in range(j) if near(shorts[i], shorts[j])] or (
            pairs[0] == sorted((i, j) for j in range(len(shorts)) for i in range(j) if near(shorts[i], shorts[j])))
        assert pairs[1] == [(i, j) for i in range(len(shorts)) for j in range(len(longs)) if near(shorts[i], longs[j])]


def plain(docs, least, least_count, times, noise):
    count = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if noise and h % noise == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                count[run] += 1
    count = {w: n for w, n in count.items() if n >= least_count}
    shapes = defaultdict(set)
    for w in count:
        for i in range(len(w)):
            shapes[w[:i], w[i + 1:]].add(w)
    friends = defaultdict(set)
    for (a, b), words in shapes.items():
        for u in words:
            friends[u] |= words - {u}
        if a + b in count:
            for u in words:
                friends[u].add(a + b)
                friends[a + b].add(u)
    form = {}
    for w, own in friends.items():
        best = min(own, key=lambda v: (-count[v], v), default=None)
        if best is not None and count[best] >= times * count[w]:
            form[w] = best
    for w, n in count.items():
        root = w
        while root in form:
            root = form[root]
        yield w, n, len(friends[w]), form.get(w), count.get(form.get(w)), root


def result(frame):
    return sorted(tuple(r) for r in frame.select("word", "n", "n_near", "form", "form_n", "root").collect())


@pytest.mark.parametrize("group", [20_000, 8])
def test_documents(spark, sf_dir, group):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 400")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert result(spelling.spelling_variants(docs, noise=31, group=group)) == sorted(plain(rows, 7, 2, 10, 31))


@pytest.mark.parametrize("group", [20_000, 3])
def test_runs_and_chains(spark, group):
    dice = random.Random(5)
    words = {"".join(dice.choice("ab") for _ in range(dice.randint(3, 7))) for _ in range(150)}
    text = " ".join(w for w in sorted(words) for _ in range(dice.choice([1, 2, 30, 400])))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = result(spelling.spelling_variants(docs, 3, 1, 10, group=group))
    assert got == sorted(plain([(1, text)], 3, 1, 10, None))
    assert any(r[5] != r[3] for r in got if r[3])


def test_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.unionByName(odd_docs).withColumn("word", odd_docs.text)
    long_word = "x" * 50_000
    more = spark.createDataFrame([(1, f"{long_word} {long_word[1:]}y {long_word[1:]} Ünlüler ünlüler ÜNLÜLER×÷ {long_word}")],
                                 "doc_id long, text string")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert result(spelling.spelling_variants(docs, 2)) == sorted(plain(rows, 2, 2, 10, None))
    rows = [tuple(r) for r in more.collect()]
    got = result(spelling.spelling_variants(more, 7, 1, 2))
    assert {(r[0], r[1]) for r in got} == {(r[0], r[1]) for r in plain(rows, 7, 1, 2, None)}
    assert {r[0]: r[2] for r in got}[long_word] == 2
    assert spelling.spelling_variants(no_docs).collect() == []
