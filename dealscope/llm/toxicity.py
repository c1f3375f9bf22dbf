"""Toxicity of texts: a convolutional classifier over hashed word embeddings, trained in numpy.

A word's embedding is the sum of the hashed vectors of the word and of its first
letters, so that inflected and compounded forms of a word share most of it.
Filters of several widths run over the words; the highest response of each, over
the whole text, goes into a logistic output. A threshold for each language, which
is told from the text itself, is calibrated on all training rows that the fit left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealscope.llm import langid, words

BUCKETS = 1 << 17
WIDTHS = (1, 2, 3)
#: Bytes of the beginnings of a word that have vectors of their own, besides the whole word.
PREFIXES = (4, 5, 6)
FILTERS = 8
DIMENSIONS = 12
EPOCHS = 6
#: At most about so many labelled rows of each label are read to fit the classifier.
MOST_ROWS = 3000
#: Words of a training text that the fit reads at once; longer texts are cut into several examples' windows.
BATCH_TEXTS = 32
SEED = 20240607
#: Bins of the histogram of raw scores for each unit, and rows of each label that a language's own threshold takes.
BINS, LEAST_ROWS = 256, 10


class Model(NamedTuple):
    """``table`` is the embeddings; ``kernels[w]`` has a (w, DIMENSIONS, FILTERS) array."""

    table: np.ndarray
    kernels: tuple[np.ndarray, ...]
    biases: np.ndarray
    output: np.ndarray
    constant: float
    languages: np.ndarray
    thresholds: np.ndarray


def features(split: words.Words) -> np.ndarray:
    """Buckets of each word: the whole and its beginnings, without case and punctuation at the ends."""
    data = split.data
    folded = langid._folded(data)
    mark = ~(((folded >= 0x61) & (folded <= 0x7A)) | ((folded >= 0x30) & (folded <= 0x39)) | (folded >= 0x80))
    letters = np.flatnonzero(~mark)
    # The first and the last letter or digit; a word without any stays as it is.
    place = np.searchsorted(letters, split.start)
    start = np.append(letters, len(data))[place]
    last = np.searchsorted(letters, split.end) - 1
    end = letters[np.maximum(last, 0)] + 1 if len(letters) else split.end
    bare = start >= split.end
    start, end = np.where(bare, split.start, start), np.where(bare, split.end, end)
    up, down = words.powers(words.WORD_BASE, len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(words._BYTE_VALUES[folded] * up[:len(data)], out=total[1:])
    out = np.empty((1 + len(PREFIXES), len(start)), np.int32)
    for n, size in enumerate((None, *PREFIXES)):
        to = end if size is None else np.minimum(end, start + size)
        out[n] = words.mix((total[to] - total[start]) * down[start], n) >> np.uint64(64 - 17)
    return out


def _responses(embedded: np.ndarray, first: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The highest response of every filter in each text, and the word where it starts (-1 for none)."""
    lengths = np.diff(first)
    high = np.zeros((len(lengths), len(WIDTHS) * FILTERS), np.float32)
    where = np.full(high.shape, -1, np.int64)
    for n, (width, kernel) in enumerate(zip(WIDTHS, model.kernels)):
        usable = np.flatnonzero(lengths >= width)
        if not len(usable):
            continue
        response = np.zeros((len(embedded), FILTERS), np.float32)
        for k in range(width):
            part = embedded @ kernel[k]
            response[:len(part) - k] += part[k:]
        # A window must not run into the next text.
        for k in range(1, width):
            response[first[1:][lengths >= k] - k] = -np.inf
        columns = slice(n * FILTERS, (n + 1) * FILTERS)
        top = np.maximum.reduceat(response, first[:-1][usable], axis=0)
        high[usable, columns] = top
        if model.table.flags.writeable:  # only the fit needs the places
            for row, d in enumerate(usable):
                where[d, columns] = response[first[d]:first[d + 1]].argmax(0) + first[d]
    return high, where


def _embed(model: Model, buckets: np.ndarray) -> np.ndarray:
    out = model.table[buckets[0]]
    for row in buckets[1:]:
        out = out + model.table[row]
    return out


def _raw_scores(model: Model, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
    high, _ = _responses(_embed(model, buckets), first, model)
    return np.maximum(high + model.biases, 0) @ model.output + model.constant


def fit(texts: pa.Array, labels: np.ndarray, seed: int = SEED, epochs: int = EPOCHS) -> Model:
    """Adam steps on the weighted log-loss; only the words with the highest responses get gradients."""
    rng = np.random.default_rng(seed)
    inputs = len(WIDTHS) * FILTERS
    table = rng.normal(0, 0.02, (BUCKETS, DIMENSIONS)).astype(np.float32)
    kernels = [rng.normal(0, 0.3 / math.sqrt(w), (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS]
    biases, output = np.full(inputs, 0.1, np.float32), rng.normal(0.3, 0.1, inputs).astype(np.float32)
    parameters = [*kernels, biases, output, np.zeros(1, np.float32)]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in parameters]
    squares = np.zeros(BUCKETS, np.float32)
    weight = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())) * len(labels)
    parts, at = [], rng.permutation(len(labels))
    for i in range(0, len(at), BATCH_TEXTS):
        chosen = at[i:i + BATCH_TEXTS]
        split = words.split(texts.take(pa.array(chosen)))
        parts.append((features(split), split.first, labels[chosen], weight[chosen]))
    step = 0
    for epoch in range(epochs):
        rate = 0.02 * (1 - epoch / epochs)
        for p in rng.permutation(len(parts)):
            buckets, first, target, scale = parts[p]
            step += 1
            model = Model(table, tuple(parameters[:len(WIDTHS)]), parameters[-3], parameters[-2],
                          float(parameters[-1][0]), np.zeros(0), np.zeros(0))
            embedded = _embed(model, buckets)
            high, where = _responses(embedded, first, model)
            active = np.maximum(high + model.biases, 0)
            score = active @ model.output + model.constant
            error = ((1 / (1 + np.exp(-np.clip(score, -30, 30))) - target) * scale / len(target)).astype(np.float32)
            back = error[:, None] * model.output * (active > 0) * (where >= 0)
            gradients = [np.zeros_like(k) for k in model.kernels] + [
                back.sum(0), active.T @ error, np.array([error.sum()], np.float32)]
            rows, columns = np.nonzero(back)
            touched, values = [], []
            for n, width in enumerate(WIDTHS):
                mine = columns // FILTERS == n
                d, f = rows[mine], columns[mine] % FILTERS
                g = back[d, columns[mine]]
                for k in range(width):
                    word = where[d, columns[mine]] + k
                    np.add.at(gradients[n][k].T, f, g[:, None] * embedded[word])
                    touched.append(word)
                    values.append(g[:, None] * model.kernels[n][k].T[f])
            if touched:
                word, value = np.concatenate(touched), np.concatenate(values)
                bucket = buckets[:, word].ravel()
                unique, inverse = np.unique(bucket, return_inverse=True)
                total = np.zeros((len(unique), DIMENSIONS), np.float32)
                np.add.at(total, inverse, np.tile(value, (len(buckets), 1)))
                squares[unique] += (total**2).mean(1)
                table[unique] -= rate * 2 * total / (np.sqrt(squares[unique])[:, None] + 1e-6)
            for p_, g, (m, v) in zip(parameters, gradients, moments):
                m *= 0.9
                m += 0.1 * g
                v *= 0.99
                v += 0.01 * g * g
                p_ -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return Model(table, tuple(parameters[:len(WIDTHS)]), parameters[-3], parameters[-2], float(parameters[-1][0]),
                 np.zeros(0), np.zeros(0))


def _language_profile(docs: DataFrame) -> np.ndarray:
    """Log-probabilities of whole-word buckets, folded to 4096, for each language of all training rows with ``lang``."""
    if "lang" not in docs.columns:
        return np.full((4096, 1), -math.log(4096), np.float32)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece in words.pieces(batch, "text"):
                split = words.split(piece.column(1))
                bucket = features(split)[0] & 4095
                for lang, i, j in zip(piece.column(0).to_pylist(), split.first, split.first[1:]):
                    counts.setdefault(lang, np.zeros(4096, np.int64))
                    counts[lang] += np.bincount(bucket[i:j], minlength=4096)
        for lang, own in counts.items():
            # A language without words is one all the same.
            at = np.union1d(np.flatnonzero(own), [0])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(own[at])],
                                             ["lang", "bucket", "n"])
    rows = docs.where("lang IS NOT NULL").select("lang", F.coalesce("text", F.lit("")).alias("text"))
    found = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = found.toArrow()
    known, language = np.unique(np.asarray(found.column("lang").to_pylist(), dtype=object), return_inverse=True)
    table = np.full((4096, max(1, len(known))), 0.5)
    table[np.asarray(found.column("bucket")), language] += np.asarray(found.column("n"))
    return np.log(table / table.sum(0)).astype(np.float32)


def _language(buckets: np.ndarray, first: np.ndarray, profile: np.ndarray) -> np.ndarray:
    """The likeliest language of each text, by its words."""
    if profile.shape[1] == 0:
        return np.zeros(len(first) - 1, np.int64)
    sums = np.concatenate([np.zeros((1, profile.shape[1])), np.cumsum(profile[buckets & 4095], axis=0, dtype=np.float64)])
    return (sums[first[1:]] - sums[first[:-1]]).argmax(1)


def _best_threshold(score: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> float:
    """The raw score that splits the labels best, in the middle of the gap; a clean text rejected counts twice.

    ``clean`` and ``toxic`` count the texts of each of the ascending scores.
    """
    below = np.concatenate([[0.0], np.cumsum(clean)]) / max(1, clean.sum())
    above = 1 - np.concatenate([[0.0], np.cumsum(toxic)]) / max(1, toxic.sum())
    value = 2 * below + above
    best = np.flatnonzero(value >= value.max() - 1e-12)
    edges = np.concatenate([[score[0] - 1], (score[1:] + score[:-1]) / 2, [score[-1] + 1]])
    return float((edges[best[0]] + edges[best[-1]]) / 2)


def _histogram(docs: DataFrame, label: DataFrame, used: list[int], model: Model) -> dict[str, np.ndarray]:
    """``language, toxic, bin, n``: raw scores of all labelled rows of ``docs`` but those of the ids ``used`` in the fit.

    Scores are made before the join, so that no text is shuffled for it.
    """
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model.table.setflags(write=False)
        for batch in batches:
            for piece in words.pieces(batch, "text"):
                split = words.split(piece.column(1))
                buckets = features(split)
                raw = np.floor(np.clip(_raw_scores(model, buckets, split.first), -1e6, 1e6) * BINS).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(_language(buckets[0], split.first, model.languages).astype(np.int32)),
                     pa.array(raw)], ["doc_id", "language", "bin"])
    spark = docs.sparkSession
    fitted = spark.createDataFrame(pa.table({"doc_id": pa.array(used, pa.int64())}))
    left = label.join(fitted, "doc_id", "left_anti")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        score, "doc_id long, language int, bin long")
    # Rows that repeat a doc_id count once.
    rows = rows.join(left, "doc_id").groupBy("doc_id").agg(
        F.min(F.struct("language", "toxic", "bin")).alias("r")).select("r.*")
    found = rows.groupBy("language", "toxic", "bin").agg(F.count(F.lit(1)).alias("n")).toArrow()
    return {c: np.asarray(found.column(c)) for c in found.column_names}


def _thresholds(found: dict[str, np.ndarray], count: int) -> np.ndarray:
    """For each language the best threshold, of those with fewer than LEAST_ROWS rows of a label the one of all."""
    def best(mine: np.ndarray, least: int) -> float | None:
        bins, place = np.unique(found["bin"][mine], return_inverse=True)
        n, toxic = found["n"][mine], found["toxic"][mine]
        counts = [np.bincount(place, n * (toxic == value), minlength=len(bins)) for value in (0, 1)]
        return _best_threshold((bins + 0.5) / BINS, *counts) if min(c.sum() for c in counts) >= least else None
    general = best(np.ones(len(found["bin"]), bool), 1)
    own = [best(found["language"] == n, LEAST_ROWS) for n in range(count)]
    return np.array([t if t is not None else general if general is not None else 0.0 for t in own])


def labelled(labels: DataFrame) -> DataFrame:
    """``doc_id, toxic`` of the labelled rows that aren't held out."""
    label = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return label.where(~langid.held_out())


def training_rows(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """``doc_id, text, toxic``: of each label about ``most`` labelled rows, or all if there are fewer.

    The share taken follows from counts; which rows, from a hash of the id. Only
    this sample reaches the driver, whatever the corpus.
    """
    label = labelled(labels)
    counts = {r["toxic"]: r["count"] for r in label.groupBy("toxic").count().collect()}
    share = F.lit(0.0)
    for value, count in counts.items():
        share = F.when(F.col("toxic") == value, F.lit(min(1.0, most / count))).otherwise(share)
    chance = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    chosen = label.where(chance < share)
    # The chosen ids are bounded by ``most``, so they go to the texts rather than the texts to them. Of several texts
    # of an id the one with the least hash counts, on every run.
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return texts.groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select(
        "doc_id", "text", "toxic")


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> Model:
    """Fit on four fifths of the sample, thresholds on all other labelled rows; ids, languages and labels are no inputs of a score."""
    rows = training_rows(docs, labels, most).orderBy("doc_id").toArrow()
    rows = rows.combine_chunks()
    label = np.asarray(rows.column("toxic")).astype(np.int64)
    if not len(label) or label.min() == label.max():
        # One label only, or none: its share is the score of every text.
        share = (label.sum() + 0.5) / (len(label) + 1)
        inputs = len(WIDTHS) * FILTERS
        return Model(np.zeros((BUCKETS, DIMENSIONS), np.float32),
                     tuple(np.zeros((w, DIMENSIONS, FILTERS), np.float32) for w in WIDTHS), np.zeros(inputs, np.float32),
                     np.zeros(inputs, np.float32), math.log(share / (1 - share)), np.zeros((4096, 1), np.float32), np.zeros(1))
    texts = rows.column("text").chunk(0)
    chosen = np.flatnonzero(np.arange(len(label)) % 5 != 0)
    model = fit(texts.take(pa.array(chosen)), label[chosen])
    model.table.setflags(write=False)
    mine = docs.where(F.col("doc_id").isNotNull() & ~langid.held_out())
    model = model._replace(languages=_language_profile(mine))
    found = _histogram(mine, labelled(labels), rows.column("doc_id").take(pa.array(chosen)).to_pylist(), model)
    return model._replace(thresholds=_thresholds(found, model.languages.shape[1]))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` for each row of ``docs`` (``doc_id``, ``text``), from the whole text.

    ``score`` lies in 0 to 1 and reaches 0.5 at the threshold of the text's language.
    Null and empty texts score what the classifier says of no words.
    """
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model.table.setflags(write=False)
        for batch in batches:
            for piece in words.pieces(batch, "text"):
                split = words.split(piece.column(1))
                buckets = features(split)
                raw = _raw_scores(model, buckets, split.first)
                raw = raw - model.thresholds[_language(buckets[0], split.first, model.languages)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(1 / (1 + np.exp(-np.clip(raw, -60, 60))), pa.float64())],
                    ["doc_id", "score"])
    return docs.select("doc_id", "text").mapInArrow(score, "doc_id long, score double")


def document_toxicity(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted``: labels come from the rows that aren't held out."""
    return scored(docs, train(docs, labels, most)).select(
        "doc_id", langid.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def not_toxic(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """The rows of ``docs`` that score below 0.5, unchanged; the decision is made row by row, without a join."""
    model = train(docs, labels, most)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model.table.setflags(write=False)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for piece in words.pieces(batch, "text"):
                split = words.split(piece.column(at))
                buckets = features(split)
                raw = _raw_scores(model, buckets, split.first)
                fine = raw < model.thresholds[_language(buckets[0], split.first, model.languages)]
                yield piece.filter(pa.array(fine))
    return docs.mapInArrow(keep, docs.schema)
