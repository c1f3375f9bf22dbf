"""Licence notices in the middle of a text, whatever its lines and sentences."""

import textwrap

from dealscope.llm import license_scan

FILL = [f"word{i}" for i in range(80)]


def scan(spark, rows):
    return license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()


def test_every_template_inside_a_paragraph(spark):
    names = sorted(license_scan.TEMPLATES)
    texts = [" ".join([*FILL, license_scan.TEMPLATES[n], *FILL]) for n in names]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, textwrap.fill(t, 76)) for i, t in enumerate(texts)]
    got = {(r.doc_id, r.license): r for r in scan(spark, rows)}
    for i, name in enumerate(names):
        assert got[i, name].dice >= 0.8 and got[1000 + i, name].dice >= 0.8, name
        if len(license_scan.TEMPLATES[name].split()) < 150:  # longer ones are most of the bigrams
            assert got[i, name].scope == "run" and got[i, name].unit == 80 and got[i, name].dice == 1.0


def test_each_occurrence_once(spark):
    mit = license_scan.TEMPLATES["MIT-notice"]
    twice = "\n".join(textwrap.wrap(" ".join([*FILL, mit, *FILL, mit, *FILL]), 76))
    other = f"first of all\n\n{mit}\n\nand " + " ".join([*FILL, mit, *FILL])
    got = sorted((r.doc_id, r.scope, r.unit) for r in scan(spark, [(1, twice), (2, other), (3, mit[:200])])
                 if r.license == "MIT-notice")
    n = len(mit.replace("/", " ").split())
    assert got == [(1, "run", 80), (1, "run", 160 + n), (2, "paragraph", 1), (2, "run", 3 + n + 1 + 80), (2, "sentence", 2)]
