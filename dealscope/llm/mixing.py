"""Mixing sources to target weights under a cap on repetitions, by water-filling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealscope.llm.tables import kept, numbered, same
from dealscope.llm.words import WORD

#: Parts of the hash range whose sizes are summed to find where the extra repetition ends.
SLICES = 4096


def water_level(sources: DataFrame, size: str, weight: str, most: float, total: float) -> float:
    """The level at which least(weight * level, most * size) sums to ``total``.

    Each round clamps the sources whose share exceeds their cap and shares what is
    left among the others, which only raises the level; it ends when no further one
    is clamped. The driver sees two sums a round. If all end at their caps, the
    level is the one that clamped the last of them.
    """
    level, cap = 0.0, F.col(size) * F.lit(float(most))
    while True:
        free = F.col(weight) * F.lit(level) <= cap
        weights, caps = sources.agg(F.sum(F.when(free, F.col(weight))), F.sum(F.when(~free, cap))).first()
        if not weights:
            return level
        raised = (total - (caps or 0.0)) / weights
        if raised <= level * (1 + 1e-12):
            return level
        level = raised


def mixed(docs: DataFrame, size: str, source: str = "source", doc_id: str = "doc_id",
          weights: tuple[float, ...] = (1.0, 2.0, 3.0), most: int = 3, seed: int = 20240607) -> DataFrame:
    """``docs`` and ``source_size``, ``target`` and ``repeats``: how often the mix takes each row.

    Sources in code point order, null last, weigh ``weights`` in turn. They share the
    sum of all sizes by weight; none gets more than ``most`` times its own, and what
    is above goes to the others by weight. Every row is taken target // source_size
    times; the rest of the target is one more repetition of the rows with the least
    seeded hash of ``doc_id``. Where the sum of sizes passes the rest, in one of SLICES
    parts of the hash range, a second hash decides row by row. So a source misses its
    target by about one of SLICES parts of its size or a row. Rows that repeat a
    ``doc_id`` share its hashes; a null ``doc_id`` hashes as an empty one. Null sizes
    count as 0; a source of size 0 has target and repeats 0.
    """
    docs = docs.withColumn("_key", F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
                                         .cast("binary")))

    def fraction(at: int):
        return F.conv(F.substring("_key", at, 8), 16, 10).cast("double") / F.lit(float(2**32))

    docs = docs.withColumns({"_slice": F.floor(fraction(1) * SLICES).cast("int"), "_second": fraction(9),
                             "_size": F.coalesce(F.col(size), F.lit(0)).cast("long")}).drop("_key")
    slices = kept(docs.groupBy(F.col(source).alias("_source"), "_slice").agg(F.sum("_size").alias("_part")), "slices")
    sources = slices.groupBy("_source").agg(F.sum("_part").alias("source_size"))
    ranked = numbered(sources.withColumn("_none", F.col("_source").isNull()), [], ["_none", "_source"], "_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    sources = kept(ranked.select("_source", "source_size", weight.alias("_weight")), "sources")
    total = float(sources.agg(F.sum("source_size")).first()[0] or 0)
    level = water_level(sources, "source_size", "_weight", most, total)
    target = F.least(F.col("_weight") * F.lit(level), F.col("source_size") * F.lit(float(most)))
    sources = sources.withColumn("target", target)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)))).otherwise(0)
    sources = sources.withColumn("_whole", whole.cast("int")).withColumn(
        "_extra", F.col("target") - F.col("_whole") * F.col("source_size"))

    upto = Window.partitionBy("_source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    filled = slices.withColumn("_upto", F.sum("_part").over(upto)).withColumnRenamed("_source", "_of")
    beyond = filled.join(sources, same({"_of": "_source"})).where("_upto > _extra")
    share = (F.col("_extra") - (F.col("_upto") - F.col("_part"))) / F.col("_part")
    ends = beyond.groupBy("_of").agg(F.min("_slice").alias("_end"), F.min_by(share, "_slice").alias("_share"))
    plan = sources.join(ends, same({"_source": "_of"}), "left").select(
        "_source", "source_size", "target", "_whole", F.coalesce("_end", F.lit(SLICES)).alias("_end"),
        F.coalesce("_share", F.lit(0.0)).alias("_share"))
    plan = kept(plan, "mix")
    more = (F.col("_slice") < F.col("_end")) | ((F.col("_slice") == F.col("_end")) & (F.col("_second") < F.col("_share")))
    out = docs.join(plan, same({source: "_source"}))
    out = out.withColumn("repeats", F.when(
        F.col("source_size") > 0, F.least(F.col("_whole") + more.cast("int"), F.lit(most))).otherwise(0))
    return out.drop("_slice", "_second", "_size", "_source", "_whole", "_end", "_share")


def word_count(text: str = "text"):
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def document_mix(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for each row of ``docs``: sizes are words.

    Null and empty texts have size 0 and take nothing; a null source is a source of its own.
    """
    sized = docs.select("doc_id", "source", word_count().alias("size"))
    return mixed(sized, "size", **options).select(
        "doc_id", "size", "source_size", "target", (F.col("repeats") * F.col("size")).cast("long").alias("taken"))


def repeated(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its repetitions, none for 0."""
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "source", word_count().alias("_words"))
    again = mixed(rows, "_words", **options).where("repeats > 0").select(
        "_row", F.explode(F.array_repeat(F.lit(0), F.col("repeats"))))
    return again.select("_row.*")
