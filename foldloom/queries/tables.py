"""Driver tables, and tables that several queries derive from them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldloom.functions.labels import mapped
from foldloom.operators.dedup import with_order_key
from foldloom.plans.vocabularies import OFFENSE


def table(spark: SparkSession, sf_dir: str, name: str, *columns) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(row_id, text, label, order_key)`` with the language as the label."""
    rows = table(spark, sf_dir, "documents", F.col("doc_id").alias("row_id"), "text", F.col("lang").alias("label"))
    return with_order_key(rows)


def offense_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled documents with the name of their toxicity code as the label."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    named = docs.join(labels, "doc_id").withColumn("label", mapped(F.col("toxic"), OFFENSE))
    return with_order_key(named.select(F.col("doc_id").alias("row_id"), "text", "label"))


# Deduped documents with their fold.
FOLDED_SQL = """
copies AS (SELECT doc_id, text, lang, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS copy FROM documents),
uniq AS (SELECT doc_id, text, lang, sha256('42|' || text) AS h FROM copies WHERE copy = 1),
folded AS (SELECT doc_id, text, lang, h, CAST(ntile(5) OVER (ORDER BY h) AS INTEGER) AS fold FROM uniq)
"""


def rotated_sql(source: str, columns: str) -> str:
    """Every row of a CTE with a ``fold`` once per rotation."""
    return f"""
SELECT {columns}, lpad(CAST(r.k AS VARCHAR), 2, '0') AS k,
       CASE WHEN fold = r.k THEN 'test' WHEN fold = r.k % 5 + 1 THEN 'valid' ELSE 'train' END AS split
FROM {source}, range(1, 6) AS r(k)
"""
