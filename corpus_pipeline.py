"""From documents to packed training sequences: five stages, each one operator over all rows of the one before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dealscope.llm import mixing, ngram_join, packing, substring_dedup, toxicity
from dealscope.llm.ship import ship
from dealscope.llm.tables import kept


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier, fitted on the labelled ones, doesn't reject."""
    ship(spark)
    return toxicity.not_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group that shares 0.8 of its five-word shingles, once; rows without id stay, and of
    rows that repeat an id with other texts those that differ."""
    ship(spark)
    groups = ngram_join.near_duplicates(docs, length=5, percent=80)
    # Written first, as Spark then knows how few they are and need not shuffle all texts to leave them out.
    later = kept(groups.where("component_id < doc_id").select("doc_id").distinct(), "later")
    return once(docs.join(later, "doc_id", "left_anti").select(*docs.columns))


def once(docs: DataFrame) -> DataFrame:
    """``docs`` without further rows of an id with the same text, which the joins by id can't tell apart. The row with
    the least hash stays. Only ids that repeat are shuffled, not the texts of the others."""
    repeated = kept(docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return docs
    again = docs.join(repeated, "doc_id", "left_semi").select(*docs.columns)
    best = F.row_number().over(Window.partitionBy("doc_id", "text").orderBy(F.xxhash64(*docs.columns)))
    first = again.withColumn("_place", best).where("_place = 1").select(*docs.columns)
    return docs.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(first)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words and more that an earlier one has; those left without a word go."""
    ship(spark)
    rest = substring_dedup.drop_repeats(docs, removed_name="_n_removed")
    emptied = (F.col("_n_removed") > 0) & ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return rest.where(~emptied).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weighted mix of sources takes them."""
    return mixing.repeated(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each document's words in training sequences."""
    ship(spark)
    return packing.document_packing(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_duplicates),
    ("substring_dedup", drop_repeats),
    ("mixing", mix_sources),
    ("packing", pack),
]
#: The classifier and the hashed packing order have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
