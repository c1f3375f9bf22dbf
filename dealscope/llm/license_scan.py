"""Licence notices in texts, by the Dice coefficient of word bigrams with templates. DataFrame functions only."""

from __future__ import annotations

import json
import math
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealscope.llm.license_texts import NOTICES, full_texts

#: Short licence notices as their licensors word them, and below them the headers and full texts.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "BSD-2-Clause-notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:"),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC-notice": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "MIT": "Released under the MIT License.",
    "MIT-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "Proprietary": "All rights reserved.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
} | NOTICES | full_texts()
THRESHOLD = 0.8
#: Texts that differ in little but a name. A unit that has the second pair of words more often than the
#: first isn't that licence.
RIVALS = {"GPL-3.0-text": ("gnu general", "affero general"), "GPL-2.0-text": ("gnu general", "affero general")}
#: What ends a unit of each scope.
SPLITS = {"paragraph": r"\n[\x20\x09]*\n", "sentence": r"\n|(?<=[.!?])[\x20\x09]+"}


def tokens(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def sequence(words: Column) -> Column:
    """The bigrams of an array of words in order, as 64-bit hashes."""
    return F.slice(F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1))), F.lit(1),
                   F.greatest(F.size(words) - 1, F.lit(0)))


def bigrams(words: Column) -> Column:
    """Distinct bigrams of an array of two words or more, as 64-bit hashes."""
    return F.array_distinct(sequence(words))


def _one(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """``rows`` and a column. Exploding one-element arrays keeps the optimizer from copying ``value`` into every
    expression that reads it."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


class Template(NamedTuple):
    """``need`` bigrams at least are shared by whatever reaches the threshold; of ``rare`` one at least is among them."""

    license: str
    words: int
    first: int
    grams: list[int]
    need: int
    rare: list[int]


def template_table(spark: SparkSession, templates: dict[str, str], threshold: float) -> list[Template]:
    """The templates' bigrams. The list has the templates' size, whatever the corpus."""
    rows = spark.createDataFrame(sorted(templates.items()), "license string, text string")
    rows = _one(rows, "words", tokens(F.col("text"))).where(F.size("words") > 1)
    out = []
    for r in rows.select("license", "words", sequence(F.col("words")).alias("grams")).orderBy("license").collect():
        # 2 * shared >= t * (a + b) and b >= shared, so shared >= a * t / (2 - t): less than all but need - 1 can't be missing.
        length = {g: len(a) + len(b) for g, a, b in zip(r["grams"], r["words"], r["words"][1:])}
        need = max(1, math.ceil(len(length) * threshold / (2 - threshold) - 1e-9))
        rare = sorted(length, key=lambda g: (-length[g], g))[:len(length) - need + 1]
        out.append(Template(r["license"], len(r["words"]), r["grams"][0], sorted(length), need, rare))
    return out


def listed(table: list[Template]) -> Column:
    """The templates as one literal: an expression for each bigram would make large plans."""
    rows = [{"license": t.license, "words": t.words, "first": t.first, "size": len(t.grams), "need": t.need,
             "grams": t.grams} for t in table]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<license string, words int, first bigint, size int, "
                                                "need int, grams array<bigint>>>")


def among(value: str, grams: Iterable[int]) -> str:
    return f"{value} IN ({', '.join(str(g) + 'L' if g != -1 << 63 else f'CAST({g} AS BIGINT)' for g in sorted(set(grams)))})"


def _times(grams: Column, pair: str) -> Column:
    first, second = pair.split(" ")
    return F.size(F.filter(grams, lambda gram: gram == F.xxhash64(F.lit(first), F.lit(second))))


def named(license: Column, grams: Column, rivals: dict[str, tuple[str, str]]) -> Column:
    """Whether a unit with these bigrams, repeated ones included, has the licence's own name as often as its rival's."""
    fits = F.lit(True)
    for name, (own, rival) in rivals.items():
        fits = fits & ((license != name) | (_times(grams, own) >= _times(grams, rival)))
    return fits


def units(docs: DataFrame) -> DataFrame:
    """``doc_id, scope, unit, words``: the whole text, its paragraphs and its sentences (which end with their line);
    those beside the text only where there are several."""
    def part(scope: str, pattern: str) -> Column:
        pieces = F.split("text", pattern)
        return F.when(F.size(pieces) > 1, F.transform(pieces, lambda p, i: F.struct(
            F.lit(scope).alias("scope"), i.cast("long").alias("unit"), tokens(p).alias("words")))).otherwise(F.array())
    whole = F.array(F.struct(F.lit("text").alias("scope"), F.lit(0).cast("long").alias("unit"),
                             tokens(F.col("text")).alias("words")))
    all_ = F.concat(whole, *[part(scope, pattern) for scope, pattern in SPLITS.items()])
    rows = docs.where("text IS NOT NULL").select("doc_id", F.explode(all_).alias("u"))
    return rows.select("doc_id", "u.scope", "u.unit", "u.words")


def _best_run() -> Column:
    """``shared, dice, end`` of the best run from ``start`` on that ends with a streak of the template's bigrams, the
    first of equal ones. One pass counts distinct bigrams, those of the run that don't stand ``before`` in it."""
    start, at, none = F.col("start"), F.col("at"), F.lit(0)
    last = F.least(start + F.col("t.words") - 2, F.size("grams") - 1)

    def step(state: Column, i: Column) -> Column:
        hit = F.coalesce(F.get(at, state["k"]) == i, F.lit(False))
        new = F.get(F.col("before"), i) < start
        distinct = state["distinct"] + new.cast("int")
        shared = state["shared"] + (new & hit).cast("int")
        dice = F.lit(2.0) * shared / (distinct + F.col("t.size"))
        ends = hit & ((i == last) | F.coalesce(F.get(at, state["k"] + 1) != i + 1, F.lit(True))) & (dice > state["dice"])
        return F.struct((state["k"] + hit.cast("int")).alias("k"), distinct.alias("distinct"), shared.alias("shared"),
                        F.when(ends, dice).otherwise(state["dice"]).alias("dice"),
                        F.when(ends, shared).otherwise(state["best"]).alias("best"),
                        F.when(ends, i + 2).otherwise(state["end"]).alias("end"))

    begin = F.struct((F.array_position(at, start).cast("int") - 1).alias("k"), none.alias("distinct"), none.alias("shared"),
                     F.lit(0.0).alias("dice"), none.alias("best"), none.alias("end"))
    return F.aggregate(F.sequence(start, last), begin, step, lambda state: F.struct(
        state["best"].cast("long").alias("shared"), state["dice"].alias("dice"), state["end"].alias("end")))


def runs(docs: DataFrame, table: list[Template], threshold: float) -> DataFrame:
    """``doc_id, scope, unit, license, shared, dice``: templates in the middle of a text, whatever its lines and sentences.

    A run has as many words as the template at most and begins and ends with one of
    its bigrams; ``unit`` is its first word, from 0. A run that begins or ends within a
    streak of the template's bigrams shares no more than one that has all of the
    streak, so only the streaks' beginnings, with all places of the template's first
    bigram, and the streaks' ends are tried. Of runs that lie in each other's middle the best counts, and
    those in a unit that reaches the threshold itself are left to ``units``.
    """
    rows = docs.where("text IS NOT NULL").select("doc_id", "text")
    rows = _one(rows, "words", tokens(F.col("text")))
    rows = _one(rows, "grams", sequence(F.col("words"))).drop("words")
    rows = rows.where(F.expr(f"exists(grams, g -> {among('g', (g for t in table for g in t.rare))})"))
    rows = _one(rows, "hits", F.expr("filter(transform(grams, (g, i) -> struct(i AS at, g AS gram)), "
                                     f"h -> {among('h.gram', (g for t in table for g in t.grams))})"))
    rows = _one(rows, "own", F.array_distinct("hits.gram"))
    fitting = F.filter(listed(table), lambda t: (t["need"] <= F.size("own")) & (
        F.size(F.array_intersect("own", t["grams"])) >= t["need"]))
    rows = _one(rows, "templates", fitting).drop("own").where(F.size("templates") > 0)
    for scope, pattern in SPLITS.items():
        marked = F.regexp_replace(F.translate("text", "\u0001", " "), pattern, " \u0001 ")
        rows = _one(rows, "_marked", F.filter(F.split(F.lower(marked), r"[^\p{L}\p{N}\x01]+"), lambda w: w != ""))
        marked = F.col("_marked")
        ends = F.filter(F.transform(marked, lambda w, i: F.when(w == "\u0001", i)), lambda i: i.isNotNull())
        # The first words of the scope's units.
        rows = _one(rows, scope, F.concat(F.array(F.lit(0)), F.transform(ends, lambda m, i: m - i))).drop("_marked")
    # Where the same bigram stood before, or -1.
    rows = _one(rows, "_sorted", F.sort_array(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))))
    rows = _one(rows, "_linked", F.sort_array(F.transform("_sorted", lambda x, j: F.struct(x["i"].alias("i"), F.when(
        (j > 0) & (F.get("_sorted", j - 1)["g"] == x["g"]), F.get("_sorted", j - 1)["i"]).otherwise(-1).alias("before")))))
    rows = _one(rows, "before", F.col("_linked.before")).drop("_sorted", "_linked")
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows = rows.select("row", "doc_id", "grams", "before", "hits", *SPLITS, F.explode("templates").alias("t"))
    t = F.col("t")
    rows = _one(rows, "mine", F.filter("hits", lambda h: F.array_contains(t["grams"], h["gram"]))).drop("hits")
    rows = _one(rows, "at", F.col("mine.at"))
    at = F.col("at")
    starts = F.filter(F.transform("mine", lambda h, k: F.when(
        ((k == 0) | (F.get(at, k - 1) < h["at"] - 1) | (h["gram"] == t["first"]))
        & (F.get(at, k + t["need"] - 1) <= h["at"] + t["words"] - 2), h["at"])), lambda p: p.isNotNull())
    rows = rows.select("row", "doc_id", "grams", "before", *SPLITS, "t", "at", F.explode(starts).alias("start"))
    rows = _one(rows, "run", _best_run()).drop("before", "at").where(F.col("run.dice") >= threshold - 1e-12)
    rows = rows.withColumn("end", F.col("run.end"))

    def score(rows: DataFrame, start: Column, end: Column) -> DataFrame:
        """``found`` of the words from ``start`` to ``end``."""
        rows = _one(rows, "_grams", F.array_distinct(F.slice("grams", start + 1, F.greatest(end - start - 1, F.lit(0)))))
        shared = F.size(F.array_intersect("_grams", F.col("t.grams"))).cast("long")
        return _one(rows, "found", F.struct(
            shared.alias("shared"), (F.lit(2.0) * shared / (F.size("_grams") + F.col("t.size"))).alias("dice"))).drop("_grams")
    own = F.slice("grams", F.col("start") + 1, F.greatest(F.col("end") - F.col("start") - 1, F.lit(0)))
    rows = rows.where(named(F.col("t.license"), own, RIVALS))
    rows = rows.withColumn("middle", F.floor((F.col("start") + F.col("end")) / 2).cast("int"))
    words = F.size("grams") + 1
    rows = score(rows, F.lit(0), words).where(F.col("found.dice") < threshold - 1e-12).drop("found")
    for scope in SPLITS:
        low = F.array_max(F.filter(scope, lambda b: b <= F.col("middle")))
        high = F.coalesce(F.array_min(F.filter(scope, lambda b: b > F.col("middle"))), words)
        rows = score(rows, low, high).where(F.col("found.dice") < threshold - 1e-12).drop("found")
    # Rows of one text are few: its runs that reach the threshold.
    rows = rows.groupBy("row", "doc_id").agg(F.collect_list(F.struct(
        F.col("run.dice").alias("dice"), F.col("t.license").alias("license"), "start", "end", "middle",
        F.col("run.shared").alias("shared"))).alias("all"))

    def beaten(r: Column, o: Column) -> Column:
        inside = (o["start"] <= r["middle"]) & (r["middle"] < o["end"]) & (r["start"] <= o["middle"]) & (o["middle"] < r["end"])
        better = (o["dice"] > r["dice"]) | ((o["dice"] == r["dice"]) & (
            (o["shared"] > r["shared"]) | ((o["shared"] == r["shared"]) & (
                (o["license"] < r["license"]) | ((o["license"] == r["license"]) & (
                    (o["start"] < r["start"]) | ((o["start"] == r["start"]) & (o["end"] < r["end"]))))))))
        return inside & better
    rows = rows.select("doc_id", F.explode(F.filter("all", lambda r: ~F.exists("all", lambda o: beaten(r, o)))).alias("r"))
    return rows.select("doc_id", F.lit("run").alias("scope"), F.col("r.start").cast("long").alias("unit"), "r.license",
                       "r.shared", "r.dice")


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, scope, unit, license, shared, dice``: the best template of each unit that reaches ``threshold``.

    A unit is a whole text, a paragraph or a sentence; ``unit`` counts from 0 in its
    scope. Notices that fill no such unit come as ``runs`` of words, whose ``unit``
    is their first word. With a and b bigrams, Dice is 2 * shared / (a + b), so only
    templates with a * t / (2 - t) <= b <= a * (2 - t) / t can reach t: shorter units
    are dropped unread, and the others only meet the templates that fit. Ties go to
    the first name. Null texts, and units or templates of fewer than two words, give
    no row.
    """
    table = template_table(docs.sparkSession, TEMPLATES if templates is None else templates, threshold)
    least = min((len(t.grams) for t in table), default=0) * threshold / (2 - threshold)
    rows = units(docs).where((F.size("words") - 1 >= F.lit(least)) & (F.size("words") > 1))
    rows = _one(rows, "grams", bigrams(F.col("words")))
    if not table:
        return rows.where("false").select("doc_id", "scope", "unit", F.lit("").alias("license"), F.lit(0).cast("long").alias(
            "shared"), F.lit(0.0).alias("dice"))
    rows = rows.where(F.expr(f"exists(grams, g -> {among('g', (g for t in table for g in t.rare))})"))
    size = F.size("grams")
    fitting = F.filter(listed(table), lambda t: (t["size"] >= size * (threshold / (2 - threshold)) - 1e-9) & (
        t["size"] <= size * ((2 - threshold) / threshold) + 1e-9))

    def scored(t: Column, i: Column) -> Column:
        shared = F.size(F.array_intersect("grams", t["grams"])).cast("long")
        dice = F.lit(2.0) * shared / (F.size("grams") + t["size"])
        # Names are counted only where the template would be found.
        real = F.when(t["license"].isin(list(RIVALS)) & (dice >= threshold - 1e-12),
                      named(t["license"], sequence(F.col("words")), RIVALS)).otherwise(F.lit(True))
        return F.struct(F.when(real, dice).otherwise(F.lit(0.0)).alias("dice"), (-i).alias("order"),
                        shared.alias("shared"), t["license"].alias("license"))
    rows = _one(rows, "_best", F.array_max(F.transform(fitting, scored))).where(
        F.col("_best.dice") >= threshold - 1e-12).select(
        "doc_id", "scope", "unit", "_best.license", "_best.shared", "_best.dice")
    return rows.unionByName(runs(docs, table, threshold))
