"""Thresholds and language profiles come from all labelled rows, not from the fit's sample."""

import numpy as np

from dealscope.llm import toxicity


def test_a_rare_language_is_calibrated(spark):
    rows = []
    for i in range(6000):
        lang = "es" if i % 20 == 0 else "en"
        toxic = i // 20 % 2
        tail = [("fine", "awful"), ("bueno", "malo")][lang == "es"][toxic]
        rows.append((i, " ".join([f"{lang}{(i * 7 + k * k) % 50}" for k in range(8)] + [tail]), lang, toxic))
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    sample = toxicity.training_rows(docs, labels, 100).join(docs.select("doc_id", "lang"), "doc_id")
    # The left-out fifth of the sample has too few rows of es.
    assert sample.where("lang = 'es' AND toxic = 1").count() < 50
    seen = []
    kept, toxicity._thresholds = toxicity._thresholds, lambda found, count: seen.append(found) or kept(found, count)
    try:
        model = toxicity.train(docs, labels, 100)
    finally:
        toxicity._thresholds = kept
    found = seen[0]
    labelled = toxicity.labelled(labels).count()
    assert labelled - 200 <= found["n"].sum() < labelled and model.languages.shape == (4096, 2)
    for language in (0, 1):
        for toxic in (0, 1):
            assert found["n"][(found["language"] == language) & (found["toxic"] == toxic)].sum() >= toxicity.LEAST_ROWS
    assert model.thresholds[0] != model.thresholds[1]


def test_histogram_threshold():
    found = {"language": np.array([0, 0, 1, 1]), "toxic": np.array([0, 1, 0, 1]), "bin": np.array([0, 512, 256, 1024]),
             "n": np.array([10, 10, 9, 30])}
    own, general = toxicity._thresholds(found, 2)
    assert abs(own - 1) < 0.01 and general != own
