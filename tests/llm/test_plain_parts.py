"""Packing against plain best fit, and the convolution against plain loops."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from dealscope.llm import packing, toxicity, words


def plain_best_fit(sizes, room):
    rooms = []
    for n in sorted(sizes, reverse=True):
        fitting = [i for i, r in enumerate(rooms) if r >= n]
        if fitting:
            rooms[min(fitting, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(room - n)
    return sorted(room - r for r in rooms)


@pytest.mark.parametrize("seed", range(8))
def test_one_length_is_plain_best_fit(seed):
    dice = random.Random(seed)
    sizes = [dice.choice([1, 2, 3, 7, 20, 33, 50, 51, 64, dice.randint(1, 100)]) for _ in range(dice.randint(1, 300))]
    counts = {n: sizes.count(n) for n in set(sizes)}
    plan = packing.pack_histogram(counts, (100,))
    filled = sorted(f for _, many, f, _ in plan.bins for _ in range(many))
    want = plain_best_fit(sizes, 100)
    assert sum(filled) == sum(sizes) == sum(want) and len(filled) == len(want)


@pytest.mark.parametrize("seed", range(8))
def test_several_lengths_hold_all_and_shrink(seed):
    dice = random.Random(100 + seed)
    lengths = (16, 32, 64, 128)
    sizes = [dice.randint(1, 128) for _ in range(400)]
    counts = {n: sizes.count(n) for n in set(sizes)}
    plan = packing.best_plan(counts, lengths)
    content = {}
    for n, own in plan.cuts.items():
        assert sum(many for many, *_ in own) == counts[n]
        for many, first, each, offset in own:
            for b in range(first, first + many // each):
                content.setdefault(b, []).extend((offset + n * i, offset + n * i + n) for i in range(each))
    seen = {}
    for first, many, filled, length in plan.bins:
        for b in range(first, first + many):
            assert b not in seen
            seen[b] = length
            spans = sorted(content[b])
            # Contents lie end to end, in the least permitted length that holds them.
            assert spans[0][0] == 0 and spans[-1][1] == filled and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
            assert length == min(n for n in lengths if n >= filled)
    assert set(seen) == set(content) and plan.cost == sum(seen.values())
    assert all(plan.cost <= packing.pack_histogram(counts, lengths, packing.padded, n).cost for n in (None, *lengths))
    assert plan.cost <= 128 * len(plain_best_fit(sizes, 128))


def test_scores_are_those_of_plain_loops():
    rng = np.random.default_rng(3)
    kernels = tuple(rng.normal(size=(w, toxicity.DIMENSIONS, toxicity.FILTERS)).astype(np.float32) for w in toxicity.WIDTHS)
    inputs = len(toxicity.WIDTHS) * toxicity.FILTERS
    model = toxicity.Model(rng.normal(size=(toxicity.BUCKETS, toxicity.DIMENSIONS)).astype(np.float32), kernels,
                           rng.normal(size=inputs).astype(np.float32), rng.normal(size=inputs).astype(np.float32), 0.25,
                           np.zeros(0), np.zeros(0))
    texts = ["one two three", "a b c d e f g h", "word " * 50, "x y z"]
    split = words.split(pa.array(texts))
    buckets = toxicity.features(split)
    embedded = toxicity._embed(model, buckets)
    want = []
    for a, b in zip(split.first, split.first[1:]):
        total = model.constant
        for n, (width, kernel) in enumerate(zip(toxicity.WIDTHS, kernels)):
            for f in range(toxicity.FILTERS):
                best = max(sum(float(embedded[i + k] @ kernel[k, :, f]) for k in range(width)) for i in range(a, b - width + 1))
                column = n * toxicity.FILTERS + f
                total += max(0.0, best + float(model.biases[column])) * float(model.output[column])
        want.append(total)
    assert toxicity._raw_scores(model, buckets, split.first) == pytest.approx(want, rel=1e-3, abs=1e-3)
    assert math.isfinite(sum(want))
