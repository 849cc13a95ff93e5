"""Joins of a large table with one that is usually small, by checked size."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20
SALTS = 64


def fits_broadcast(small: DataFrame) -> bool:
    """Measure a table that may be small, reading no more of it than the bound."""
    measured = small.select(F.octet_length(F.to_json(F.struct(*small.columns))).alias("b"))
    row = measured.limit(BROADCAST_ROWS + 1).agg(F.count("*"), F.coalesce(F.sum("b"), F.lit(0))).first()
    return row[0] <= BROADCAST_ROWS and row[1] <= BROADCAST_BYTES


def null_safe_join(large: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Inner or left join in which a null key meets a null key; the keys of ``large`` are kept."""
    renamed = small.withColumnsRenamed({name: f"_on_{name}" for name in on})
    same = reduce(Column.__and__, [F.col(name).eqNullSafe(F.col(f"_on_{name}")) for name in on])
    return large.join(renamed, same, how).drop(*[f"_on_{name}" for name in on])


def lookup_join(
    large: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner", fits: bool | None = None
) -> DataFrame:
    """Join with a table that has one row per key.

    ``fits=True`` is for a table bounded by construction; with ``None`` its size is measured.
    A table that does not fit is joined by a salted shuffle, since one key of the large side may
    hold a large part of its rows: each large row takes one salt, each small row is repeated
    under every salt.
    """
    if fits is None:
        fits = fits_broadcast(small)
    if fits:
        return null_safe_join(large, F.broadcast(small), list(on), how)
    salted = large.withColumn("_salt", F.pmod(F.xxhash64(*large.columns), F.lit(SALTS)))
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    return null_safe_join(salted, repeated, [*on, "_salt"], how).drop("_salt")
