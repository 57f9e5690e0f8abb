"""The operators applied to the driver's tables, with production parameters.

Each query takes ``(spark, sf_dir)``, reads its whole table and returns the
operator's full result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cofreq.llm import (dac, divergence, embed_dedup, lexical, mixing, ngram_lm, packing, quality, secrets, simhash,
                        substring, topk, toxicity)
from cofreq.llm.common import table


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.embedding_top_k(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op6_dac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dac.encode_documents(table(spark, sf_dir, "documents"))


def op7_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.9)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_pieces(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"), ngram=3)


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score_documents(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_toxicity": op2_toxicity,
    "op3_topk": op3_topk,
    "op4_substring": op4_substring,
    "op5_mixing": op5_mixing,
    "op6_dac": op6_dac,
    "op7_embed_dedup": op7_embed_dedup,
    "op8_packing": op8_packing,
    "op9_quality": op9_quality,
    "op10_simhash": op10_simhash,
    "op11_lexical": op11_lexical,
    "op12_divergence": op12_divergence,
    "op13_lm": op13_lm,
}

ORACLE: dict[str, str] = {
    "op3_topk": topk.ORACLE,
    "op5_mixing": mixing.ORACLE,
    "op11_lexical": lexical.ORACLE,
    "op12_divergence": divergence.ORACLE,
}
