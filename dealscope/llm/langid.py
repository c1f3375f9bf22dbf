"""Language of texts and of their parts: script ranges, per-word scores, and Viterbi with a switching penalty.

A word's script, from the range of its first letter, leaves only the languages
that are written in it. Its score for each of them is the mean log-probability of
its byte n-grams, from counts over all training texts. Viterbi then labels the
words of a text, paying ``penalty`` for each change of language, so that a stray
word doesn't open a span but a sentence does.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealscope.llm import words

#: Hashed n-grams: buckets for each language. Counts of all languages make up the model.
BUCKETS = 1 << 15
PENALTY = 6.0
#: First bytes in UTF-8 of the ranges of scripts (Latin, Greek, Cyrillic, Armenian, Hebrew, Arabic,
#: Indic and South-East Asian, kana and symbols, Han, Hangul).
SCRIPTS = ((0x41, 0x5A), (0x61, 0x7A), (0xC3, 0xC9), (0xCD, 0xCF), (0xD0, 0xD3), (0xD4, 0xD5), (0xD6, 0xD7),
           (0xD8, 0xDB), (0xE0, 0xE1), (0xE2, 0xE3), (0xE4, 0xE9), (0xEA, 0xED))
_SCRIPT = np.zeros(256, np.int8)
for _number, (_low, _high) in enumerate(SCRIPTS):
    _SCRIPT[_low:_high + 1] = 1 if _number < 3 else _number
N_SCRIPTS = len(SCRIPTS)


class Model(NamedTuple):
    """``scores[bucket, language]``: log-probabilities; ``allowed[script, language]``."""

    languages: tuple[str, ...]
    scores: np.ndarray
    allowed: np.ndarray


def _folded(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z as a-z, and the second bytes of capital Latin-1 letters as those of small ones."""
    out = data.copy()
    upper = (out >= 0x41) & (out <= 0x5A)
    second = np.zeros(len(out), bool)
    second[1:] = (data[:-1] == 0xC3) & (data[1:] <= 0x9E)
    out[upper | second] += 0x20
    return out


def _grams(split: words.Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte 1- to 3-grams that end at each byte of ``data``, one row per length, and whether the byte
    is in a word. A word's n-grams start at the space before it."""
    data = _folded(split.data).astype(np.uint32)
    inside = np.zeros(len(data), np.int32)
    np.add.at(inside, split.start, 1)
    ends = split.end[split.end < len(data)]
    np.add.at(inside, ends, -1)
    inside = np.cumsum(inside) > 0
    data[~inside] = 32
    before = np.concatenate([[np.uint32(32)], data[:-1]]).astype(np.uint32)
    before[split.offsets[:-1][split.offsets[:-1] < len(data)]] = 32
    second = np.concatenate([[np.uint32(32)], before[:-1]]).astype(np.uint32)
    second[before == 32] = 32
    out = np.empty((3, len(data)), np.int32)
    for n, code in enumerate((data, data | before << np.uint32(8),
                              data | before << np.uint32(8) | second << np.uint32(16))):
        code = (code + np.uint32((n + 1) << 24)) * np.uint32(0x9E3779B1)
        out[n] = code >> np.uint32(32 - 15)
    return out, inside


def _word_scripts(split: words.Words) -> np.ndarray:
    """The script of the first letter-like byte of each word, 0 for none."""
    scripts = _SCRIPT[split.data].astype(np.int16)
    at = np.flatnonzero(scripts)
    place = np.searchsorted(at, split.start)
    found = np.append(at, len(split.data))[place]
    return np.where(found < split.end, np.append(scripts, 0)[found], 0)


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Counts over all rows of ``docs`` with a text and a language, summed by Spark.

    The driver gets one row per language and bucket or script, at most
    BUCKETS + N_SCRIPTS for each language, however large the corpus.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece in words.pieces(batch, "text"):
                split = words.split(piece.column(0))
                buckets, inside = _grams(split)
                scripts = _word_scripts(split)
                names = piece.column(1).to_pylist()
                for i, name in enumerate(names):
                    total = totals.setdefault(name, np.zeros(BUCKETS + N_SCRIPTS, np.int64))
                    span = slice(int(split.offsets[i]), int(split.offsets[i + 1]))
                    total[:BUCKETS] += np.bincount(buckets[:, span][:, inside[span]].ravel(), minlength=BUCKETS)
                    total[BUCKETS:] += np.bincount(scripts[split.first[i]:split.first[i + 1]], minlength=N_SCRIPTS)
        for name, total in totals.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used)), pa.array(used, pa.int32()), pa.array(total[used])], ["lang", "bucket", "n"])

    labelled = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        "text IS NOT NULL AND lang IS NOT NULL")
    counts = labelled.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")).toArrow()
    names = counts.column("lang").to_pylist()
    languages = tuple(sorted(set(names)))
    table = np.zeros((BUCKETS + N_SCRIPTS, len(languages)))
    place = {name: i for i, name in enumerate(languages)}
    table[np.asarray(counts.column("bucket")), [place[n] for n in names]] = np.asarray(counts.column("n"))
    grams, scripts = table[:BUCKETS], table[BUCKETS:]
    scores = np.log((grams + 0.5) / (grams.sum(0) + 0.5 * BUCKETS)).astype(np.float32)
    # A language is written in the scripts of at least a hundredth of its words.
    allowed = scripts >= np.maximum(1, scripts.sum(0) * 0.01)
    allowed[0] = True
    allowed[~allowed.any(1)] = True
    return Model(languages, scores, allowed)


def _word_scores(split: words.Words, model: Model) -> np.ndarray:
    """Per word and language: the n-gram scores' mean over the word times the square root of its bytes, less
    the best one's, so that long words count more but not without bound."""
    buckets, _ = _grams(split)
    total = np.zeros((len(split.data) + 1, len(model.languages)), np.float32)
    each = model.scores[buckets[0]] + model.scores[buckets[1]] + model.scores[buckets[2]]
    np.cumsum(each, axis=0, dtype=np.float64, out=(sums := np.zeros(total.shape)[1:]))
    sums = np.concatenate([np.zeros((1, sums.shape[1])), sums])
    out = sums[split.end] - sums[split.start]
    out /= np.sqrt(np.maximum(1, split.end - split.start))[:, None]
    scripts = _word_scripts(split)
    out[~model.allowed[scripts]] = -np.inf
    out -= out.max(axis=1, keepdims=True)
    np.maximum(out, -50.0, out=out)
    # Words without letters say nothing.
    out[scripts == 0] = 0.0
    return out


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of each word, for all texts of a batch side by side.

    ``scores`` has a row per word; text d holds rows ``first[d]`` to ``first[d + 1]``.
    """
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    starts, steps = first[:-1][order], int(lengths.max(initial=0))
    active = np.searchsorted(-lengths[order], -np.arange(steps), "left")  # texts longer than t
    n_labels = scores.shape[1]
    labels = np.zeros(len(scores), np.int8 if n_labels < 128 else np.int32)
    came = np.zeros(scores.shape, bool)  # whether the label was entered by a switch
    from_ = np.zeros(len(scores), labels.dtype)  # and from which
    best = np.zeros((len(lengths), n_labels), np.float32)
    for t in range(steps):
        n = active[t]
        rows = starts[:n] + t
        if t:
            top = best[:n].argmax(1)
            entry = best[np.arange(n), top][:, None] - penalty
            switch = entry > best[:n]
            came[rows], from_[rows] = switch, top
            best[:n] = np.where(switch, entry, best[:n])
        best[:n] += scores[rows]
        best[:n] -= best[:n].max(1, keepdims=True)
    label = np.zeros(len(lengths), labels.dtype)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        rows = starts[:n] + t
        later = active[t + 1] if t + 1 < steps else 0
        if later:
            ahead = rows[:later] + 1
            switched = came[ahead, label[:later]]
            label[:later] = np.where(switched, from_[ahead], label[:later])
        label[later:n] = best[later:n].argmax(1)
        labels[rows] = label[:n]
    return labels


def _has_letter(column: pa.Array, split: words.Words) -> list[bool]:
    ascii_letter = np.concatenate([[0], np.cumsum(((split.data | 0x20) >= 0x61) & ((split.data | 0x20) <= 0x7A))])
    found = ascii_letter[split.offsets[1:]] > ascii_letter[split.offsets[:-1]]
    return [bool(f) or any(c.isalpha() for c in column[i].as_py() or "") for i, f in enumerate(found)]


def spans(docs: DataFrame, model: Model, penalty: float = PENALTY) -> DataFrame:
    """``doc_id, lang_pred, score, spans`` for each row of ``docs`` (``doc_id``, ``text``).

    ``spans`` lists (lang, first_word, n_words) over the whole text. ``lang_pred`` is
    the language with most bytes of letter words, the first by name among equals, and
    ``score`` its share of them. Texts that are null or have no letter, and all texts
    if no language was learned, are ``und`` with score 0 and no spans.
    """
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            splits = [(piece, words.split(piece.column(1))) for piece in words.pieces(batch, "text")]
            if not splits:
                continue
            # Viterbi steps through a whole batch of texts at once.
            scores = np.concatenate([_word_scores(s, model).astype(np.float32) for _, s in splits])
            base = np.cumsum([0] + [len(s.start) for _, s in splits])
            first = np.concatenate([s.first[:-1] + b for (_, s), b in zip(splits, base)] + [base[-1:]])
            labels = viterbi(scores, first, penalty)
            for (piece, split), b in zip(splits, base):
                own = labels[b:b + len(split.start)]
                size = np.where(_word_scripts(split) > 0, split.end - split.start, 0)
                letters = _has_letter(piece.column(1), split)
                names, shares, parts = [], [], []
                for i, ok in enumerate(letters):
                    a, z = int(split.first[i]), int(split.first[i + 1])
                    if not ok or a == z:
                        names.append("und")
                        shares.append(0.0)
                        parts.append([])
                        continue
                    weight = np.bincount(own[a:z], size[a:z], len(model.languages))
                    if not weight.any():
                        weight = np.bincount(own[a:z], minlength=len(model.languages)).astype(float)
                    top = int(weight.argmax())
                    names.append(model.languages[top])
                    shares.append(float(weight[top] / weight.sum()))
                    edges = np.flatnonzero(np.diff(own[a:z])) + 1
                    bounds = [0, *edges.tolist(), z - a]
                    parts.append([{"lang": model.languages[own[a + s]], "first_word": s, "n_words": e - s}
                                  for s, e in zip(bounds, bounds[1:])])
                yield pa.RecordBatch.from_arrays([
                    piece.column(0), pa.array(names, pa.string()), pa.array(shares, pa.float64()),
                    pa.array(parts, pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int32()),
                                                        ("n_words", pa.int32())])))],
                    ["doc_id", "lang_pred", "score", "spans"])

    schema = "doc_id long, lang_pred string, score double, spans array<struct<lang string, first_word int, n_words int>>"
    rows = docs.select("doc_id", "text")
    if not model.languages:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.expr(
            "CAST(array() AS array<struct<lang: string, first_word: int, n_words: int>>)").alias("spans"))
    return rows.mapInArrow(label, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is kept from training: crc32 of the id as text, modulo 5, is 0. Rows without id are trained on."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def document_languages(docs: DataFrame, penalty: float = PENALTY) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: learned from the rows that aren't held out."""
    model = train(docs.where(~held_out()))
    return spans(docs, model, penalty).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
