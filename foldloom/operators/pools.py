"""Rotation of folds into train, valid and test pools, and what is read off them."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldloom.operators.folds import N_FOLDS

SPLITS = ("train", "valid", "test")


def split_of(fold: Column, rotation: Column, n_folds: int = N_FOLDS) -> Column:
    """In rotation r, fold r is the test set, the next one (cyclic) the valid set, the rest the train set."""
    return (
        F.when(fold == rotation, "test").when(fold == rotation % n_folds + 1, "valid").otherwise("train")
    )


def rotate(folded: DataFrame, n_folds: int = N_FOLDS) -> DataFrame:
    """Every row once per rotation, with ``k`` as '01', '02', ... and its ``split``; a narrow step."""
    rotations = F.array(*[F.lit(i) for i in range(1, n_folds + 1)])
    turned = folded.withColumn("_k", F.explode(rotations))
    return turned.select(
        "*",
        F.format_string("%02d", "_k").alias("k"),
        split_of(F.col("fold"), F.col("_k"), n_folds).alias("split"),
    ).drop("_k")


def split_sizes(folded: DataFrame, within: Sequence[str] = (), n_folds: int = N_FOLDS) -> DataFrame:
    """Rows per rotation and split. Folds are counted first, so only the counts are rotated."""
    sizes = folded.groupBy(*within, "fold").agg(F.count("*").alias("_n"))
    return rotate(sizes, n_folds).groupBy(*within, "k", "split").agg(F.sum("_n").alias("n_rows"))


def few_shot(
    folded: DataFrame, shots: int, within: Sequence[str] = (), label: str = "label", n_folds: int = N_FOLDS
) -> DataFrame:
    """The first ``shots`` train rows per rotation and class in seeded order; repeatable.

    A row that is among the first of a train pool is among the first of its fold as well, so the
    folds are cut down before they are rotated.
    """
    in_fold = Window.partitionBy(*within, "fold", label).orderBy("order_key")
    first = folded.withColumn("_rank", F.row_number().over(in_fold)).where(F.col("_rank") <= shots).drop("_rank")
    in_pool = Window.partitionBy(*within, "k", label).orderBy("order_key")
    train = rotate(first, n_folds).where("split = 'train'")
    return (
        train.withColumn("shot", F.row_number().over(in_pool)).where(F.col("shot") <= shots).drop("split")
    )
