"""The raw table of a corpus from one file or a list of files."""

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldloom.plans.spec import CorpusSpec, Delimited, JsonLines
from foldloom.sources.delimited import scan_delimited
from foldloom.sources.jsonl import scan_jsonl


def scan_converted(spark: SparkSession, path: str, columns: Sequence[str], input_no: int = 0) -> DataFrame | None:
    """Parquet with its own row numbers; None when it is missing or lacks a column."""
    try:
        raw = spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if not set(columns) <= set(raw.columns):
        return None
    row_id = F.struct(
        F.lit(input_no).alias("input_no"),
        F.col("_metadata.file_name").alias("file"),
        F.lit(0).cast("bigint").alias("block"),
        F.col("_metadata.row_index").alias("seq"),
    )
    return raw.select(
        *[F.col(f"`{name}`").cast("string").alias(name) for name in columns],
        row_id.alias("row_id"),
        F.lit(None).cast("string").alias("fault"),
    )


def scan_input(spark: SparkSession, spec: CorpusSpec, path: str, input_no: int = 0) -> DataFrame | None:
    if isinstance(spec.source, Delimited):
        return scan_delimited(spark, path, spec.columns, spec.source, input_no)
    if isinstance(spec.source, JsonLines):
        return scan_jsonl(spark, path, spec.columns, spec.source, input_no)
    return scan_converted(spark, path, spec.columns, input_no)


def without_ragged_files(raw: DataFrame, column: str) -> DataFrame:
    """Drop whole inputs that hold an over-long row. One row per listed input is broadcast at most."""
    keyed = raw.withColumn("_input", F.col("row_id.input_no"))
    counts = keyed.groupBy("_input").agg(
        F.count_if(F.col("fault") == "ragged").alias("n_ragged"), F.count(f"`{column}`").alias("n_filled")
    )
    # Spark refuses a file query that uses the bad-record column alone, so a data column is counted too.
    ragged = counts.where("n_ragged > 0 AND n_filled >= 0").select("_input")
    return keyed.join(F.broadcast(ragged), "_input", "left_anti").drop("_input")


def scan_inputs(spark: SparkSession, spec: CorpusSpec, paths: Sequence[str]) -> DataFrame | None:
    """All usable inputs one after another in list order; None when none is left.

    With several inputs a missing, incomplete or ragged one is left out. A single ragged input
    is kept, and its fault fails the corpus.
    """
    scans = [scan_input(spark, spec, path, no) for no, path in enumerate(paths)]
    usable = [scan for scan in scans if scan is not None]
    if not usable:
        return None
    raw = reduce(DataFrame.unionByName, usable)
    if len(paths) > 1 and isinstance(spec.source, Delimited):
        return without_ragged_files(raw, spec.text_column)
    return raw
