"""Exact dedup with a defined survivor."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldloom.functions.text import SEED, order_key


def with_order_key(rows: DataFrame, seed: int = SEED, text: str = "text") -> DataFrame:
    return rows.withColumn("order_key", order_key(F.col(text), seed))


def dedup_first(rows: DataFrame, row_id: str = "row_id", within: Sequence[str] = ()) -> DataFrame:
    """One row per exact text, the one with the lowest ``row_id``, so its label wins.

    The rank filter is planned as a group limit on both sides of the shuffle: every map task sends
    at most one row per text, so a text that fills a third of the input does not fill a task.
    The key is the 32-byte ``order_key``; a consumer that does not need the text does not shuffle it.
    """
    copies = Window.partitionBy(*within, "order_key").orderBy(row_id)
    return rows.withColumn("_copy", F.row_number().over(copies)).where("_copy = 1").drop("_copy")


def dedup_stats(rows: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Rows before and after dedup, and removed."""
    texts = rows.groupBy(*within, "order_key").agg(F.count("*").alias("copies"))
    before = F.coalesce(F.sum("copies"), F.lit(0))
    return texts.groupBy(*within).agg(
        before.alias("rows_before"),
        F.count("*").alias("rows_after"),
        (before - F.count("*")).alias("rows_removed"),
    )
