"""Document fingerprints by consistent weighted sampling. DataFrame expressions only.

A text is a vector of words (runs without white space) with their counts as weights. For each of ``SAMPLES`` samples every word draws, from a hash of
word and sample number, ``r`` and ``c`` from Gamma(2, 1) and ``b`` from the unit interval; with its weight ``w`` it takes
``t = floor(ln w / r + b)`` and ``a = c / exp(r * (t - b + 1))``. The word with the smallest ``a``, together with its ``t``, is the sample. Two texts agree in a sample with a
probability equal to their generalised Jaccard similarity, the sum of smaller weights over the sum of larger ones.

Each sample is one ``min`` over whole numbers, ``ln a`` in the upper bits and 24 bits of the choice in the lower ones, so all
samples of a text are one hash aggregation whose partial rows are complete but for the exchange. A fingerprint is the 24-bit numbers in hexadecimal.

``edited`` compares each text with the text whose last third is replaced by the beginning of the next document by descending id. Neighbours are
found within ranges of ids, from one exchange by range; only one row per range passes through a single task.

A null or empty text, or one of white space only, has the fingerprint ''; two of these are alike (1.0), one and another text are not (0.0). Null ids come last.
Rows with equal ids are ordered by hash and length of their texts and are neighbours of each other. Columns beside id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldloom.storage import stage

SAMPLES = 32
WHITE = " \t\n\x0b\f\r"


def with_terms(rows: DataFrame, text: str, out: str) -> DataFrame:
    """``out``: an array of ``h, w``, the words of a text by hash and how often each occurs. Steps are columns, so that none is
    computed again inside a lambda."""
    trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(WHITE))
    rows = rows.withColumn("_words", F.when(trimmed != "", F.split(trimmed, "[ \t\n\x0b\f\r]+")).otherwise(F.array().cast("array<string>")))
    rows = rows.withColumn("_sorted", F.sort_array(F.transform("_words", lambda w: F.xxhash64(w)))).drop("_words")
    rows = rows.withColumn("_n", F.size("_sorted"))
    new = lambda h, i: (i == 0) | (h != F.get("_sorted", i - 1))
    places = F.transform("_sorted", lambda h, i: F.when(new(h, i), i))
    rows = rows.withColumn("_starts", F.filter(places, lambda i: i.isNotNull()))
    entry = lambda i, j: F.struct(
        F.get("_sorted", i).alias("h"), (F.coalesce(F.get("_starts", j + 1), F.col("_n")) - i).alias("w")
    )
    return rows.withColumn(out, F.transform("_starts", entry)).drop("_sorted", "_n", "_starts")


def sample(h: Column, log_w: Column, number: int) -> Column:
    """The key of a word in a sample: the smaller, the sooner it is chosen."""
    one, two = F.xxhash64(h, F.lit(2 * number)), F.xxhash64(h, F.lit(2 * number + 1))
    unit = lambda x, shift: (F.shiftrightunsigned(x, shift).bitwiseAND(F.lit(0xFFFFFF)) + 1) / F.lit(float(1 << 24))
    r = -F.log(unit(one, 40) * unit(one, 16))
    c = -F.log(unit(two, 40) * unit(two, 16) * F.lit(1 - 2.0**-50))
    b = one.bitwiseAND(F.lit(0xFFFF)) / F.lit(65536.0)
    t = F.floor(log_w / r + b)
    log_a = F.greatest(F.log(c) - r * (t - b + 1), F.lit(-63.0))
    choice = F.shiftrightunsigned(h, 40).bitwiseXOR(t.bitwiseAND(F.lit(0xFFFFFF)))
    return F.shiftleft(F.floor((log_a + 64) * F.lit(float(1 << 32))), 24).bitwiseOR(choice)


def signatures(rows: DataFrame, terms: dict[str, int], key: str = "row") -> DataFrame:
    """``key, which, signature``: of each of the named columns of terms, under its number; none for a column without terms."""
    def numbered(column: str, number: int) -> Column:
        return F.transform(column, lambda e: F.struct(F.lit(number).alias("which"), e.h.alias("h"), e.w.alias("w")))

    both = F.concat(*(numbered(c, n) for c, n in terms.items()))
    # An inner explode would filter on the size of the array first, and cut the words again inside each lambda for that.
    flat = rows.select(key, both.alias("e")).select(key, F.explode_outer("e").alias("e")).where("e is not null")
    flat = flat.select(key, "e.which", "e.h", F.log(F.col("e.w").cast("double")).alias("log_w"))
    found = flat.groupBy(key, "which").agg(*(F.min(sample(F.col("h"), F.col("log_w"), i)).alias(f"s{i}") for i in range(SAMPLES)))
    return found.select(key, "which", F.array(*(F.col(f"s{i}").bitwiseAND(F.lit(0xFFFFFF)) for i in range(SAMPLES))).alias("signature"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples; null stands for a text without words."""
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.lit(float(SAMPLES))
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(equal)


def fingerprint(signature: Column) -> Column:
    return F.coalesce(F.array_join(F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x)), 6, "0")), ""), F.lit(""))


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row, next_row, doc_id, text, next_text``: the next row by descending id, after the last the first."""
    spark = docs.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    steps = [i / parts for i in range(1, parts)]
    cuts = rows.select(F.percentile_approx("doc_id", steps, 20 * parts)).first()[0] or []
    cuts = F.array(*(F.lit(c).cast("bigint") for c in sorted(set(cuts)))) if cuts else F.array().cast("array<bigint>")
    # Ranges are numbered from the largest ids down; the last one is for null ids.
    rows = rows.withColumn("part", F.when(F.col("doc_id").isNull(), F.lit(parts)).otherwise(F.size(F.filter(cuts, lambda c: c > F.col("doc_id")))))
    order = Window.partitionBy("part").orderBy(F.desc_nulls_last("doc_id"), F.xxhash64("text"), F.length("text"))
    ranked = rows.withColumn("rank", F.row_number().over(order))
    firsts = ranked.where("rank = 1").select("part", F.col("text").alias("first_text"))
    chain = Window.orderBy("part")  # one row for each range
    nexts = firsts.select(
        "part",
        F.coalesce(F.lead("part").over(chain), F.first("part").over(chain.rowsBetween(Window.unboundedPreceding, 0))).alias("next_part"),
        F.coalesce(F.lead("first_text").over(chain), F.first("first_text").over(chain.rowsBetween(Window.unboundedPreceding, 0))).alias("next_first"),
    )
    ahead = ranked.withColumn("ahead", F.lead("text").over(order))
    row = lambda part, rank: F.shiftleft(part.cast("bigint"), 40) + rank
    last = F.col("ahead").isNull()
    return ahead.join(nexts, "part").select(
        row(F.col("part"), F.col("rank")).alias("row"),
        F.when(last, row(F.col("next_part"), F.lit(1))).otherwise(row(F.col("part"), F.col("rank") + 1)).alias("next_row"),
        "doc_id", "text", F.when(last, F.col("next_first")).otherwise(F.col("ahead")).alias("next_text"),
    )


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` for every row."""
    rows = with_next(docs, id_col, text_col).withColumn("n_chars", F.length("text").cast("bigint"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    changed = F.concat(F.expr("substring(text, 1, cast(n_chars - floor(n_chars / 3) as int))"), F.substring(F.col("next_text"), F.lit(1), third))
    rows = rows.withColumn("changed", changed).drop("next_text")
    facts = stage(rows.select("row", "next_row", "doc_id", "n_chars", F.sha2("changed", 256).alias("edited_sha256")))
    terms = with_terms(with_terms(rows.select("row", "text", "changed"), "text", "a"), "changed", "b")
    found = stage(signatures(terms.select("row", "a", "b"), {"a": 0, "b": 1}))
    own = found.where("which = 0").select("row", F.col("signature").alias("own"))
    other = found.where("which = 1").select("row", F.col("signature").alias("other"))
    following = own.select(F.col("row").alias("next_row"), F.col("own").alias("following"))
    joined = facts.join(own, "row", "left").join(other, "row", "left").join(following, "next_row", "left")
    return joined.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"), fingerprint(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("following")).alias("near_next"),
    )
