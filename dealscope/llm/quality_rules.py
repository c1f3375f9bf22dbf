"""Quality rules: a table of thresholds compiled into one projection over text statistics."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it was on are as with his they at be this from have or by had not but what all were"
    " der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass"
    " le la les et des en un une du est que dans qui par pour au sur pas plus ce il elle"
    " de el los las que y se del por con para una su al lo como más pero sus"
).split()
SYMBOLS = "#*$%&|<>"
#: A word with a letter of the list's scripts, or without any letter.
LATIN = r"[A-Za-z\u00C0-\u024F]|^\P{L}*$"
_SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


class Rule(NamedTuple):
    """``low <= measure <= high``; a null measure passes."""

    name: str
    measure: str
    low: float
    high: float


#: Measures are SQL over the statistics of ``statistics``.
RULES = (
    Rule("words", "n_words", 50, float("inf")),
    Rule("repeated", "n_repeat_words / nullif(n_words, 0)", 0, 0.5),
    Rule("word_length", "word_chars / nullif(n_words, 0)", 2, 15),
    Rule("symbols", "n_symbols / nullif(n_words, 0)", 0, 0.1),
    # The list holds words in Latin letters only: it says nothing about texts in other scripts.
    Rule("stop_words", "CASE WHEN 2 * n_latin_words >= n_words THEN n_stop_words / nullif(n_words, 0) END", 0.02, 0.9),
    Rule("repeated_lines", "n_dup_lines / nullif(n_lines, 0)", 0, 0.6),
)


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` and ``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_stop_words, n_latin_words``, all long.

    Lines end at newlines; those without a word count nowhere. ``n_dup_lines`` are
    equal to an earlier line. ``n_repeat_words`` are the words in 3-word windows that
    the text has twice or more, the first included; windows are compared by 64-bit
    hashes within one text. ``n_latin_words`` have a Latin letter or no letter. Null and empty texts give zeros.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.withColumn("_words", F.filter(F.split(body, r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    # Each layer is read twice or more by the next one, so it is computed once.
    rows = rows.withColumns({
        "n_words": F.size("_words"),
        "_windows": F.when(F.size("_words") >= 3, F.slice(
            F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2))),
            F.lit(1), F.size("_words") - 2)).otherwise(F.array().cast("array<bigint>")),
        "_lines": F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
        "n_stop_words": F.size(F.filter("_words", lambda w: F.lower(w).isin(STOP_WORDS))),
        "n_latin_words": F.size(F.filter("_words", lambda w: w.rlike(LATIN))),
    })
    rows = rows.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    again = F.filter("_sorted", lambda x, j: (x["h"] == F.get("_sorted", j - 1)["h"]) | (
        x["h"] == F.get("_sorted", j + 1)["h"]))
    covered = F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    longs = {
        "n_words": F.col("n_words"),
        "word_chars": F.length(F.translate(body, _SPACES, "")),
        "n_symbols": F.length(body) - F.length(F.translate(body, SYMBOLS, "")),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.when(F.col("_sorted").isNull(), 0).otherwise(F.size(covered)),
        "n_stop_words": F.col("n_stop_words"),
        "n_latin_words": F.col("n_latin_words"),
    }
    return rows.withColumns({c: e.cast("long") for c, e in longs.items()}).drop("_words", "_windows", "_lines", "_sorted")


def compiled(rules: tuple[Rule, ...]) -> dict[str, Column]:
    """For each rule whether it holds."""
    def holds(rule: Rule) -> Column:
        measure = F.expr(rule.measure).cast("double")
        fits = measure >= F.lit(float(rule.low))
        if rule.high != float("inf"):
            fits = fits & (measure <= F.lit(float(rule.high)))
        return F.coalesce(fits, F.lit(True))
    return {rule.name: holds(rule) for rule in rules}


def judged(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs``, the statistics, ``failed`` (names of the rules that don't hold) and ``kept``."""
    checks = compiled(rules)
    failed = F.filter(F.array(*[F.when(~ok, F.lit(name)) for name, ok in checks.items()]), lambda n: n.isNotNull())
    return statistics(docs, text).withColumn("failed", failed).withColumn("kept", F.size("failed") == 0)


def document_quality(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept`` for each row."""
    base = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return judged(docs.select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
        (~base & F.col("kept")).alias("kept"))
