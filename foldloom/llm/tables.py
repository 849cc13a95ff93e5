"""Tables and checks that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str, *columns) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """True for the rows of a fold that a model must not learn from: crc32 of the id as text."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts == part
