"""The queries of this subpackage over the driver tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldloom.llm import (
    decontamination, fingerprints, hyperminhash, language, licenses, manifest, mixing, ngram_join, quality, substring_dedup, token_alignment,
    toxicity, warc,
)
from foldloom.llm.tables import held_out, table
from foldloom.storage import new_folder

# Where the vocabulary files of the public tokenizers are.
TOKENIZERS = "/opt/tokenizers"

QUERIES = {}
ORACLES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_join(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    out = held_out(F.col("doc_id"), 5, 0)
    labels = table(spark, sf_dir, "labels", "doc_id", F.col("toxic").alias("label")).where(~out)
    machine = toxicity.train(docs, labels)
    return toxicity.score(docs, machine).select("doc_id", out.alias("held_out"), "score", "predicted")


@query
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents", "doc_id", "text"))


ORACLES["op4_licenses"] = licenses.oracle()


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark) + "/warc"
    index = warc.write(table(spark, sf_dir, "pages", "page_id", "url", "html"), folder)
    return warc.read(index, folder).drop("url", "payload")


@query
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    out = held_out(F.col("doc_id"), 4, 2)
    model = language.train(docs.where(~out))
    return language.predict(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score")


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text")
    return decontamination.matches(docs, items).drop("row")


@query
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source is a document's host, and its language the path below it."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", F.col("source").alias("host"), F.col("lang").alias("path"))
    labels = table(spark, sf_dir, "labels", "doc_id", F.col("quality").alias("label"))
    return quality.scores(docs, labels)


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents", "doc_id", "source"))


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return token_alignment.alignment(docs, f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")


@query
def op12_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(table(spark, sf_dir, "documents"), new_folder(spark))


ORACLES["op13_manifest"] = manifest.oracle()
