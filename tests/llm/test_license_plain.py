"""Licence notices against plain Dice over all runs of words, with stray template words beside them."""

import random
import re

import pytest

from dealscope.llm import license_scan

FILL = [f"word{i}" for i in range(60)]


def words(text):
    return [w for w in re.split(r"[^\w]+|_", text.lower()) if w]


def grams(own):
    return list(zip(own, own[1:]))


def best_run(text, template):
    """The best Dice of any run of at most the template's words."""
    own, wanted = grams(words(text)), set(grams(words(template)))
    best = 0.0
    for a in range(len(own)):
        for b in range(a + 1, min(len(own), a + len(words(template)) - 1) + 1):
            run = set(own[a:b])
            best = max(best, 2 * len(run & wanted) / (len(run) + len(wanted)))
    return best


def scan(spark, rows, **options):
    return license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string"), **options).collect()


def test_part_of_a_notice_with_stray_bigrams_behind(spark):
    notice = license_scan.TEMPLATES["MIT-notice"].split()[:47]
    rows = [(1, " ".join([*FILL, *notice, *FILL])), (2, " ".join([*FILL, *notice, "and", "to", "the", *FILL])),
            (3, " ".join([*FILL, *notice, *FILL[:9], "granted", "free", "of", *FILL]))]
    got = {r.doc_id: r.dice for r in scan(spark, rows) if r.license == "MIT-notice"}
    for doc_id, text in rows:
        assert got[doc_id] == pytest.approx(best_run(text, license_scan.TEMPLATES["MIT-notice"]))


def test_runs_find_the_best_of_all_runs(spark):
    dice = random.Random(2)
    templates = {n: license_scan.TEMPLATES[n] for n in ("ISC-notice", "MPL-2.0", "CC-BY-4.0", "MIT")}
    rows = []
    for i in range(80):
        own = words(templates[dice.choice(sorted(templates))])
        lo = dice.randrange(max(1, len(own) // 6))
        part = own[lo:len(own) - dice.randrange(max(1, len(own) // 6))]
        for _ in range(dice.randrange(3)):
            part[dice.randrange(len(part))] = "odd"
        stray = [dice.choice(own) for _ in range(6)]
        at = dice.randrange(len(own) - 1)
        rows.append((i, " ".join([*dice.sample(FILL, 30), *stray, *part, *dice.sample(FILL, dice.randrange(1, 5)),
                                  *own[at:at + 2], *dice.sample(FILL, 30)])))
    got = {}
    for r in scan(spark, rows, templates=templates):
        got[r.doc_id, r.license] = max(r.dice, got.get((r.doc_id, r.license), 0))
    for i, text in rows:
        best = {n: best_run(text, t) for n, t in templates.items()}
        top = max(best.values())
        if top >= 0.8:
            assert max(d for (j, _), d in got.items() if j == i) == pytest.approx(top), (i, best)
        else:
            assert not any(j == i for j, _ in got)


def test_a_text_under_another_name_is_no_gpl(spark):
    text = license_scan.TEMPLATES["GPL-3.0-text"]
    other = re.sub(r"(?i)GNU General", "GNU Affero General", text)
    some = re.sub(r"(?i)GNU General", "GNU Affero General", text, count=13)
    rows = [(1, text), (2, other), (3, some), (4, " ".join([*FILL, text, *FILL])), (5, " ".join([*FILL, other, *FILL]))]
    got = {(r.doc_id, r.license) for r in scan(spark, rows) if r.license.endswith("-text")}
    assert got == {(1, "GPL-3.0-text"), (4, "GPL-3.0-text")}


def test_odd_rows(spark, odd_docs, no_docs):
    assert license_scan.license_scan(odd_docs).collect() == []
    assert license_scan.license_scan(no_docs).collect() == []
    mit = license_scan.TEMPLATES["MIT-notice"]
    rows = [(1, mit), (1, mit), (1, "nothing"), (None, mit), (2, "x " * 20_000 + mit)]
    got = [r.doc_id for r in scan(spark, rows) if r.license == "MIT-notice" and r.scope in ("text", "run")]
    assert sorted(got, key=str) == [1, 1, 2, None]
