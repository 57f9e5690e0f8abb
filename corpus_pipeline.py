"""The corpus pipeline: five stages over ``documents``, each one of the
operators of ``cofreq.llm``.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.

* toxicity: documents that the classifier rejects go;
* near duplicates: one document of each SimHash group stays;
* secrets: every secret is replaced by a mark, the document stays;
* mixing: each document comes as often as the mix takes it, up to three times,
  so sources meet their target weights;
* packing: pieces of sequences of 1024 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cofreq.llm import mixing, packing, secrets, simhash, toxicity
from cofreq.llm.common import table
from cofreq.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, ngram=3)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_pieces(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("source_mixing", mix_sources),
    ("packing", pack),
]

#: The classifier and the Markov models have no SQL form; the stages are tested
#: against plain versions in ``tests/llm/test_pipeline.py``.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
