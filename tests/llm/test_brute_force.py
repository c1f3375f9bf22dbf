"""Operators against plain versions, on the given tables and on planted cases."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from dealscope.llm import langid, ngram_join, packing, sharding, substring_dedup, toxicity, words

WORD = re.compile(words.WORD)


def small(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, length):
    w = WORD.findall(small(text))
    return {tuple(w[i:i + length]) for i in range(len(w) - length + 1)} if len(w) >= length else ({tuple(w)} if w else set())


def brute_components(rows, length, percent):
    sets = {i: shingles(t, length) for i, t in rows}
    having = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            having[g].append(i)
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, s in sets.items():
        shared = defaultdict(int)
        for g in s:
            for j in having[g]:
                if j < i:
                    shared[j] += 1
        for j, m in shared.items():
            if 100 * m >= percent * (len(s) + len(sets[j]) - m):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


def brute_repeats(rows, length):
    tokens = {i: WORD.findall(t or "") for i, t in rows}
    first = {}
    for i in sorted(tokens):
        for j in range(len(tokens[i]) - length + 1):
            first.setdefault(tuple(tokens[i][j:j + length]), i)
    out = {}
    for i, w in tokens.items():
        gone = [False] * len(w)
        for j in range(len(w) - length + 1):
            if first[tuple(w[j:j + length])] < i:
                gone[j:j + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.fixture(scope="module")
def given(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return docs, [tuple(r) for r in docs.collect()]


@pytest.fixture(scope="module")
def near_copies(spark):
    """Copies of one text with nought to four edits each: many pairs just above and below the threshold."""
    rng = random.Random(3)
    base = [f"word{rng.randrange(10**6)}" for _ in range(90)]
    rows = []
    for i in range(260):
        text = list(base)
        for _ in range(rng.randrange(5)):
            text[rng.randrange(len(text))] = f"edit{rng.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5), rows


@pytest.mark.parametrize("length,percent", [(3, 90), (5, 80)])
def test_near_duplicates_of_given_table(given, length, percent):
    docs, rows = given
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs, length, percent).collect()}
    assert got == brute_components(rows, length, percent)


def test_near_copies_around_the_threshold(near_copies):
    docs, rows = near_copies
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs, 3, 90).collect()}
    want = brute_components(rows, 3, 90)
    assert got == want and 20 < len({c for _, c in want.values()}) < 250


def test_every_similar_pair_shares_an_index_entry():
    rng = np.random.default_rng(5)
    for percent in (50, 80, 90):
        for size in (2, 5, 9, 17, 40, 150, 700):
            for _ in range(40):
                a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
                drop, add = rng.integers(0, max(1, size // 4), 2)
                b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 2**64, add, dtype=np.uint64)]))
                both = len(np.intersect1d(a, b))
                if 100 * both >= percent * (len(a) + len(b) - both) and both < max(len(a), len(b)):
                    assert set(ngram_join.signatures(a, percent).tolist()) & set(ngram_join.signatures(b, percent).tolist())
                    assert ngram_join.differing_bits(ngram_join.parity(a), ngram_join.parity(b)) <= len(a) + len(b) - 2 * both


@pytest.mark.parametrize("length,seed", [(50, 16), (12, 5)])
def test_substrings_of_given_table(given, length, seed):
    docs, rows = given
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256)
           for r in substring_dedup.substring_digest(docs, length, seed).collect()}
    assert got == brute_repeats(rows, length)


def test_dropped_repeats_leave_the_same_words(given):
    docs, rows = given
    want = brute_repeats(rows, 50)
    for r in substring_dedup.drop_repeats(docs).collect():
        assert hashlib.sha256(" ".join(WORD.findall(r.text or "")).encode()).hexdigest() == want[r.doc_id][2]
        if not r.n_removed:
            assert r.text == dict(rows)[r.doc_id]


def test_best_fit_against_plain_best_fit():
    rng = random.Random(1)
    sizes = sorted((rng.randint(1, 60) for _ in range(400)), reverse=True)
    rooms = []
    for s in sizes:
        fitting = [i for i, r in enumerate(rooms) if r >= s]
        if fitting:
            rooms[min(fitting, key=lambda i: (rooms[i], i))] -= s
        else:
            rooms.append(100 - s)
    classes = [sharding.SizeClass(s, sizes.count(s), 0) for s in sorted(set(sizes), reverse=True)]
    cuts = sharding.best_fit(classes, 100)
    used = {shard for own in cuts for _, shard in own}
    assert len(used) == len(rooms)


def test_shards_keep_groups_and_sizes(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r.doc_id: r for r in sharding.document_shards(docs, 8).collect()}
    texts, total, slots = defaultdict(set), defaultdict(int), defaultdict(list)
    for d in docs.collect():
        r = rows[d.doc_id]
        assert (r.size, r.text_crc32) == (len(d.text.encode()) + 1, zlib.crc32(d.text.encode()))
        texts[d.text].add(r.shard)
        total[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in texts.values()) and set(total) == set(range(8))
    assert max(total.values()) < 1.02 * min(total.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_packing_is_whole_and_tight(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lengths = (64, 128, 300)
    bins, pieces = defaultdict(list), defaultdict(list)
    for r in packing.document_packing(docs, lengths).collect():
        bins[r.bin].append(r)
        pieces[r.doc_id].append((r.start, r.tokens))
    for d in docs.collect():
        at = 0
        for start, tokens in sorted(pieces.get(d.doc_id, [])):
            assert start == at
            at += tokens
        assert at == len(WORD.findall(d.text))
    for own in bins.values():
        own.sort(key=lambda r: r.bin_offset)
        at = 0
        for r in own:
            assert r.bin_offset == at
            at += r.tokens
        assert at == own[0].bin_tokens and own[0].bin_length == min(n for n in lengths if n >= at)
    assert sorted(bins) == list(range(len(bins)))


def test_languages_held_out(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = langid.document_languages(docs).join(docs, "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_spans_of_mixed_text(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.train(docs)
    texts = {r.lang: r.text for r in docs.where("n_chars BETWEEN 800 AND 2000").orderBy("doc_id").collect()}
    parts = [" ".join(WORD.findall(texts[lang])[:60]) for lang in ("en", "fr")]
    got = langid.spans(spark.createDataFrame([(1, " ".join(parts))], "doc_id long, text string"), model).first()
    assert [s.lang for s in got.spans][0] == "en" and [s.lang for s in got.spans][-1] == "fr"
    assert sum(s.n_words for s in got.spans) == sum(len(WORD.findall(p)) for p in parts)


def test_viterbi_against_all_paths():
    from itertools import product
    rng = np.random.default_rng(2)
    for _ in range(30):
        scores = rng.normal(0, 2, (6, 3)).astype(np.float32)
        got = langid.viterbi(scores, np.array([0, 6]), 1.5)
        value = lambda p: sum(scores[i, l] for i, l in enumerate(p)) - 1.5 * sum(a != b for a, b in zip(p, p[1:]))
        assert value(tuple(got)) == pytest.approx(max(map(value, product(range(3), repeat=6))), abs=1e-4)


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.document_toxicity(docs, labels).where("held_out").join(labels, "doc_id").collect()
    caught = sum(r.predicted and r.toxic for r in rows) / sum(r.toxic for r in rows)
    alarms = sum(r.predicted and not r.toxic for r in rows) / sum(not r.toxic for r in rows)
    assert caught > 0.8 and alarms < 0.05


def test_entries_of_many_blocks(spark, monkeypatch):
    """Texts that share a segment's subset but aren't all similar, compared block by block."""
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    dice = random.Random(11)
    base = [[f"w{dice.randint(0, 500)}" for _ in range(60)] for _ in range(3)]
    rows = []
    for i in range(150):
        words_ = list(dice.choice(base))
        for _ in range(dice.choice([0, 1, 2, 5, 9])):
            words_[dice.randrange(60)] = f"x{dice.randint(0, 40)}"
        rows.append((i, " ".join(words_)))
    rows += [(200 + i, rows[i % 7][1]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for length, percent in ((3, 90), (5, 80), (1, 60)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs, length, percent).collect()}
        assert got == brute_components(rows, length, percent)
