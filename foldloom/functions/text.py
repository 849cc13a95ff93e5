"""Text expressions: stripping, blank and null tests, the seeded order key."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that Python's str.strip() removes.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The whole-field tokens that a pandas CSV read takes as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

SEED = 42


def strip(text: Column) -> Column:
    """Remove Unicode white space from both ends.

    ``btrim`` with an explicit character list is linear and works on the UTF-8 bytes; the
    regular expression with two anchors that does the same is several times slower.
    """
    return F.btrim(text, F.lit(WHITE_SPACE))


def is_blank(text: Column) -> Column:
    """True for an empty text or one of white space only. A trim from the left stops at the first other character."""
    return F.ltrim(text, F.lit(WHITE_SPACE)) == ""


def na_to_null(field: Column) -> Column:
    """Missing-value tokens of a delimited file become null; anything else is kept as it is."""
    return F.when(~field.isin(*NA_TOKENS), field)


def title_and_body(title: Column, body: Column) -> Column:
    """Title, one space, body, with nulls as empty strings.

    ``concat_ws`` would leave the space out when one of them is null.
    """
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(body, F.lit("")))


def first_item(items: Column, sep: str = ",") -> Column:
    """The first entry of a separated list, stripped."""
    return strip(F.substring_index(items, sep, 1))


def text_digest(text: Column) -> Column:
    """32 bytes that stand for the exact text in a shuffle."""
    return F.unhex(F.sha2(text, 256))


def order_key(text: Column, seed: int = SEED) -> Column:
    """The place of a text in the seeded shuffle, as 32 bytes compared from the left.

    It depends on the seed and the text alone, so the order is the same under any partitioning
    and any input order. It is a SHA-256 digest, so equal keys also mean equal texts, and
    dedup, shuffle order and fold limits can all use this one short column.
    """
    return F.unhex(F.sha2(F.concat(F.lit(f"{seed}|"), text), 256))
