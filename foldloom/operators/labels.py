"""Label operators on tables."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldloom.functions.labels import is_admitted, mapped, mapped_or_kept
from foldloom.joins import lookup_join


def whitelist(rows: DataFrame, admitted: Sequence, label: str = "label") -> DataFrame:
    return rows.where(is_admitted(F.col(label), admitted))


def relabel_keep(rows: DataFrame, mapping: Mapping, label: str = "label") -> DataFrame:
    """Mapped labels; those without a mapping stay."""
    return rows.withColumn(label, mapped_or_kept(F.col(label), mapping))


def relabel_drop(rows: DataFrame, mapping: Mapping, label: str = "label") -> DataFrame:
    """Mapped labels, several of which may become one; rows without a mapping go."""
    return rows.withColumn(label, mapped(F.col(label), mapping)).where(F.col(label).isNotNull())


def relabel_by_table(
    rows: DataFrame, vocabulary: DataFrame, label: str = "label", keep_unmapped: bool = True, fits: bool | None = None
) -> DataFrame:
    """As above with the vocabulary in a table ``(raw, label)``, one row per raw label."""
    small = vocabulary.select(F.col("raw").alias(label), F.col("label").alias("_new"))
    joined = lookup_join(rows, small, [label], "left" if keep_unmapped else "inner", fits)
    new = F.coalesce("_new", label) if keep_unmapped else F.col("_new")
    return joined.withColumn(label, new).drop("_new")


def unmapped_report(rows: DataFrame, mapping: Mapping, label: str = "label") -> DataFrame:
    """The labels that the mapping lacks, with their rows."""
    missing = rows.where(F.col(label).isNotNull() & ~F.col(label).isin(*mapping))
    return missing.groupBy(label).agg(F.count("*").alias("n_rows"))
