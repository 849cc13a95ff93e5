"""Numeric coercion of label strings."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as a number. Spark's own cast also takes '5d', '5f' and hexadecimal.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+|(?i:inf(inity)?))([eE][+-]?\d+)?\s*$"


def to_number(value: Column) -> Column:
    """The value as a double, null when it is not a number. Infinity is a number here."""
    return F.when(value.rlike(NUMBER), value.try_cast("double"))


def to_integer(number: Column) -> Column:
    """Toward zero: 4.7 is 4 and -0.5 is 0. Null when it does not fit, as infinity."""
    return number.try_cast("int")


def is_bad_number(value: Column) -> Column:
    """True for a value that has no integer form at all: not a number, or infinite."""
    number = to_number(value)
    return value.isNotNull() & (number.isNull() | (F.abs(number) == float("inf")))
