"""The named queries of this package, each a thin call of its operator, and SQL for those that have it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dealscope.llm import (exact_topk, html_text, langid, license_scan, mixing, ngram_join, packing, quality_rules,
                           sharding, spelling, substring_dedup, token_align, toxicity)
from dealscope.llm.oracle import ORACLE as ORACLE
from dealscope.llm.ship import ship

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 8
#: Every so many runs of letters lose one, so that there are misspellings to group.
NOISE = 31
#: Where the files of public tokenizers lie on every machine.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")


def _over(operator: Callable[..., DataFrame], *tables: str, **options) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return operator(*[spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in tables], **options)
    return run


QUERIES: dict[str, Query] = {
    "op1_sharding": _over(sharding.document_shards, "documents", shards=SHARDS),
    "op2_ngram_jaccard": _over(ngram_join.near_duplicates, "documents", length=3, percent=90),
    "op3_packing": _over(packing.document_packing, "documents"),
    "op4_quality_rules": _over(quality_rules.document_quality, "documents"),
    "op5_substring_dedup": _over(substring_dedup.substring_digest, "documents"),
    "op6_exact_topk": _over(exact_topk.embedding_neighbours, "embeddings"),
    "op7_mixing": _over(mixing.document_mix, "documents"),
    "op8_license_scan": _over(license_scan.license_scan, "documents"),
    "op9_language_id": _over(langid.document_languages, "documents"),
    "op10_toxicity": _over(toxicity.document_toxicity, "documents", "labels"),
    "op11_html_text": _over(html_text.main_text, "pages"),
    "op12_spelling_variants": _over(spelling.spelling_variants, "documents", noise=NOISE),
    "op13_token_alignment": _over(token_align.document_alignment, "documents",
                                  a_path=f"{TOKENIZERS}/byte_bpe_50k.json", b_path=f"{TOKENIZERS}/piece_bpe_32k.model"),
}
