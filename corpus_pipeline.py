"""The training-corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, as
it changes them; its result is written as Parquet and reread as the next one's
``docs``.  All stages keep the columns of ``documents``; the mix may return a
document several times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chaintally.llm import decontaminate, mixing, secrets, simhash_dedup, toxicity
from chaintally.llm.common import table
from chaintally.session import delete_folders, staged_scope, staging_path


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity model (learned from ``labels``) calls toxic go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash_dedup.keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; a document that is nothing else goes."""
    return decontaminate.remove_contamination(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret values are masked."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are repeated or thinned to their target words."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_dedup", drop_near_copies),
    ("decontaminate", remove_benchmark),
    ("secrets", mask_secrets),
    ("mix", mix_sources),
]

# Learned weights, fingerprints and guess costs are not SQL; tests/llm compares with a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the last stage; what a stage staged, and the result before it, go when its own is written."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, step in STAGES:
        path = staging_path(spark, f"pipeline-{name}")
        with staged_scope(spark):
            kept = step(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        delete_folders(spark, before)
        before = [path]
    return docs
