"""The corpus pipeline: documents pass the stages one after another, each written as Parquet and read again for the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldloom.llm import decontamination, mixing, ngram_join, substring_dedup, toxicity
from foldloom.llm.tables import held_out, table
from foldloom.storage import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine takes for toxic go. It learns from the labelled rows outside the held-out fold."""
    labels = table(spark, sf_dir, "labels", "doc_id", F.col("toxic").alias("label"))
    machine = toxicity.train(docs, labels.where(~held_out(F.col("doc_id"), 5, 0)))
    return toxicity.keep_clean(docs, machine)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by n-gram Jaccard similarity the one with the smallest id stays."""
    return ngram_join.representatives(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows that occur elsewhere too are taken out; ``n_chars`` follows the text."""
    return substring_dedup.remove_repeats(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its slot in the mixture of sources."""
    return mixing.mix_sources(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", one_of_each_group),
    ("substring_dedup", without_repeats),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
]

# Fitted models and FM-indexes have no counterpart in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
