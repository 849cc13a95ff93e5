"""Expressions over one JSON value held as VARIANT."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def kind(value: Column) -> Column:
    """'STRING', 'BIGINT', 'VOID' (JSON null) and so on; '-' for a missing key."""
    return F.coalesce(F.schema_of_variant(value), F.lit("-"))


def as_string(value: Column) -> Column:
    """The string itself, or the JSON text of any other value; JSON null is null."""
    return F.try_variant_get(value, "$", "string")


def is_falsy(value: Column) -> Column:
    """Null, missing, "", 0, false, [] and {}. White space alone is not falsy."""
    string = as_string(value)
    other = string.isin("false", "[]", "{}") | (F.coalesce(string.try_cast("double"), F.lit(1.0)) == 0)
    return string.isNull() | F.when(kind(value) == "STRING", string == "").otherwise(other)


def truthy_string(value: Column) -> Column:
    """The value as a string, null when it is falsy."""
    return F.when(~is_falsy(value), as_string(value))
