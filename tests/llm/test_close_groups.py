"""Groups of near copies that are mostly not similar: rows grow with their documents, not with their pairs."""

import random
from itertools import combinations

import numpy as np
import pytest

from dealscope.llm import ngram_join
from tests.llm.test_brute_force import brute_components

PERCENT = 80


def random_sets(seed, count, most=9):
    """Sets of 60 shingles that lack and add up to ``most`` each, of three families."""
    rng = np.random.default_rng(seed)
    base = [rng.integers(1, 2**64, 60, dtype=np.uint64) for _ in range(3)]
    out = []
    for _ in range(count):
        own = base[rng.integers(3)].copy()
        own[rng.choice(60, rng.integers(0, most), replace=False)] += np.uint64(rng.integers(1, 4))
        out.append(np.unique(own))
    return out


def roots(count, pairs):
    up = list(range(count))
    for a, b in pairs:
        low, high = sorted((up[a], up[b]))
        up = [low if u == high else u for u in up]
    return up


def close(a, b):
    bits = ngram_join.differing_bits(ngram_join.parity(a), ngram_join.parity(b))
    sizes = min(len(a), len(b)) * 100 >= max(len(a), len(b)) * PERCENT
    return sizes and bits * (100 + PERCENT) <= (len(a) + len(b)) * (100 - PERCENT)


def similar(a, b):
    both = len(np.intersect1d(a, b))
    return both * 100 >= (len(a) + len(b) - both) * PERCENT


def arguments(sets, components, blocks):
    return np.array([len(s) for s in sets]), [ngram_join.parity(s) for s in sets], components, blocks, PERCENT


def test_a_component_proposes_few_pairs():
    one = random_sets(1, 1)[0]
    sets, apart, block = [one] * 200, np.arange(200), np.zeros(200, int)
    x, p, more = ngram_join.close_pairs(*arguments(sets, apart, block), 2)
    assert len(x) <= 400 and more.all()


@pytest.mark.parametrize("held", [1, 1 << 18])
def test_pairs_left_out_are_of_components_with_more(monkeypatch, held):
    monkeypatch.setattr(ngram_join, "HELD_PAIRS", held)
    for seed in range(20):
        sets = random_sets(seed, 40)
        components, block = np.random.default_rng(seed).integers(0, 25, 40), np.zeros(40, int)
        x, p, more = ngram_join.close_pairs(*arguments(sets, components, block), 2)
        got = {(min(a, b), max(a, b)) for a, b in zip(x, p)}
        every = {(a, b) for a, b in combinations(range(40), 2) if components[a] != components[b] and close(sets[a], sets[b])}
        held_back = set(components[x[more]]) | set(components[p[more]])
        assert got <= every and len(got) <= 2 * 25
        assert all({components[a], components[b]} <= held_back for a, b in every - got)


def test_tied_and_joined_places_against_all_pairs():
    for seed in range(30):
        sets = random_sets(seed, 50)
        rng = np.random.default_rng(seed)
        components, block = rng.integers(0, 40, 50), np.sort(rng.integers(0, 1 + seed % 2, 50))
        two = block[0] != block[-1]
        pairs = [(a, b) for a, b in combinations(range(50), 2) if components[a] != components[b]
                 and (not two or block[a] != block[b])]
        tied = ngram_join.tied_places(*arguments(sets, components, block))
        assert tied.tolist() == roots(50, [(a, b) for a, b in pairs if close(sets[a], sets[b])])
        known = [(a, b) for a, b in combinations(range(50), 2) if components[a] == components[b]]
        found = ngram_join.joining_pairs(sets, components, block, PERCENT)
        assert len(found) < 50 and all(similar(sets[a], sets[b]) for a, b in found)
        want = known + [(a, b) for a, b in pairs if similar(sets[a], sets[b])]
        assert roots(50, known + found) == roots(50, want)


def near_copies(count):
    """Texts of 46 words of which the last six differ: similarity 0.75 of five-word shingles."""
    shared = " ".join(f"s{i}" for i in range(40))
    return [(i, shared + " " + " ".join(f"d{i}x{j}" for j in range(6))) for i in range(count)]


def test_rows_grow_with_the_documents_of_a_group(spark, monkeypatch):
    made = {}
    write = ngram_join.kept

    def kept(rows, label):
        out = write(rows, label)
        if label == "asked":
            made[count] = made.get(count, 0) + out.count()
        return out
    monkeypatch.setattr(ngram_join, "kept", kept)
    for count in (60, 240):
        docs = spark.createDataFrame(near_copies(count), "doc_id long, text string")
        got = ngram_join.near_duplicates(docs, 5, PERCENT)
        assert got.where("component_id <> doc_id").isEmpty()
    # All pairs would be 16 times as many.
    assert made[240] < 6 * made[60]


def test_groups_of_several_blocks(spark, monkeypatch):
    """Similar pairs that the first proposals miss are found by the search of sets, block by block."""
    joined = []
    join = ngram_join._joining

    def joining(*args):
        out = join(*args)
        joined.append(out.count())
        return out
    monkeypatch.setattr(ngram_join, "_joining", joining)
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    monkeypatch.setattr(ngram_join, "SHINGLES", 1 << 9)
    monkeypatch.setattr(ngram_join, "FIRST_PAIRS", 1)
    dice = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(160):
        words = list(base)
        for _ in range(dice.choice([4, 5, 6])):
            words[dice.randrange(60)] = f"x{dice.randint(0, 200)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs, 1, PERCENT).collect()}
    assert got == brute_components(rows, 1, PERCENT)
    assert joined[0]
    # An id that repeats with another text, and one with texts without a word.
    rows += [(3, rows[90][1]), (3, rows[90][1]), (5, ""), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs, 1, PERCENT).collect()}
    # Texts of an id as documents of their own that are one by definition.
    component = brute_components([(i, text) for i, (_, text) in enumerate(rows)], 1, PERCENT)
    want = roots(len(rows), [(i, c) for i, (_, c) in component.items()] + [(i, doc_id) for i, (doc_id, _) in enumerate(rows)])
    assert got == {doc_id: want[i] for i, (doc_id, _) in enumerate(rows)}
