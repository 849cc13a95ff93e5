"""Label expressions over a literal vocabulary."""

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Star ratings and their polarity; three stars have none.
STAR_POLARITY = {1: "Negativo", 2: "Negativo", 4: "Positivo", 5: "Positivo"}


def vocabulary(mapping: Mapping) -> Column:
    """The mapping as a map literal, which Catalyst folds into a constant."""
    return F.create_map(*[F.lit(item) for pair in mapping.items() for item in pair])


def mapped(label: Column, mapping: Mapping) -> Column:
    """The mapped label, null without a mapping. Keys are case- and accent-exact."""
    return F.try_element_at(vocabulary(mapping), label)


def mapped_or_kept(label: Column, mapping: Mapping) -> Column:
    return F.coalesce(mapped(label, mapping), label.cast("string"))


def is_admitted(label: Column, admitted: Iterable) -> Column:
    """False for a null label as well."""
    return F.coalesce(label.isin(*list(admitted)), F.lit(False))


def star_polarity(stars: Column) -> Column:
    return mapped(stars, STAR_POLARITY)
