"""Benchmark decontamination by SimHash over item-sized windows of words. DataFrame expressions only.

A text's words are runs without white space, in lower case; its shingles are runs of five words (the whole sequence if there are fewer). For
an item of ``n`` words the windows are the runs of ``n`` words of a document, or the whole document if it is shorter.

1. Shingles of documents meet those of items by hash. A window with a similarity of at least ``t`` holds at least ``t`` of the
   item's shingles, so only windows around enough shared shingles within ``n`` words are fingerprinted; this loses none.
2. Each window and item gets a 64-bit SimHash of its shingles, each counted as often as it occurs.
3. Multi-index: fingerprints are cut into 8 blocks of 8 bits. Two that differ in at most ``RADIUS = 23`` bits differ in at most 2 bits of some block, so
   windows meet the items' blocks with up to two bits flipped, among items of the same length, and the whole fingerprints are compared.
4. Candidates are verified by weighted Jaccard similarity of the shingles, with their counts as weights.

A similar window's fingerprint is further than the radius about once in half a million times at a similarity of 0.8, and less often above.

The shingles of the items are broadcast if there are at most ``BROADCAST_ROWS`` of them, and joined by a shuffle otherwise. Texts of documents without
candidates are not shuffled. Null and empty texts or items match nothing. Repeated rows match one by one, and rows with
equal ids and different texts are told apart. Repeated items give a row for each different id. Rows and items with a null id match like
others. Columns beside id and text are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldloom.storage import stage

SHINGLE = 5
PERCENT = 80
RADIUS = 23
BLOCKS = 8
BROADCAST_ROWS = 1_000_000
WHITE = " \t\n\x0b\f\r"


def _few(df: DataFrame) -> bool:
    return df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def _join(large: DataFrame, small: DataFrame, on: list[str], few: bool) -> DataFrame:
    return large.join(F.broadcast(small) if few else small, on)


def words(text: Column) -> Column:
    trimmed = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(WHITE))
    return F.when(trimmed != "", F.split(trimmed, "[ \t\n\x0b\f\r]+"))


def shingles(own: Column) -> Column:
    """Hashes of the runs of five words; null without words."""
    firsts = F.sequence(F.lit(1), F.greatest(F.size(own) - (SHINGLE - 1), F.lit(1)))
    return F.when(own.isNotNull(), F.transform(firsts, lambda i: F.xxhash64(F.slice(own, i, SHINGLE))))


def simhash(windows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, fingerprint`` from rows with ``keys`` and ``shingles``: each bit is that of most shingles."""
    rows = windows.select(*keys, F.explode("shingles").alias("h"))
    bit = lambda b: F.shiftrightunsigned("h", b).bitwiseAND(F.lit(1))
    sums = rows.groupBy(*keys).agg(F.count("*").alias("n"), *(F.sum(bit(b)).alias(f"s{b}") for b in range(64)))
    set_bit = lambda b: F.when(2 * F.col(f"s{b}") > F.col("n"), F.shiftleft(F.lit(1).cast("bigint"), b)).otherwise(F.lit(0))
    return sums.select(*keys, reduce(Column.bitwiseOR, (set_bit(b) for b in range(64))).alias("fingerprint"))


def block(fingerprint: Column, number: int) -> Column:
    return F.shiftrightunsigned(fingerprint, 8 * number).bitwiseAND(F.lit(255)).cast("int")


# All patterns of at most two of eight bits.
FLIPS = [x for x in range(256) if x.bit_count() <= RADIUS // BLOCKS]


def overlap(a: Column, b: Column) -> Column:
    """Size of the intersection of two arrays as multisets."""
    both = F.array_intersect(a, b)
    times = lambda own, h: F.size(F.filter(own, lambda x: x == h))
    counted = F.aggregate(both, F.lit(0), lambda n, h: n + F.least(times(a, h), times(b, h)))
    plain = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    return F.when(plain, F.size(both)).otherwise(counted)


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            item_text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """``row, doc_id, item_id, start, n_words, similarity``: for each document and item that match, the most similar window, the first one in a
    tie. ``row`` tells rows of ``docs`` apart: ``row_key`` of id and text."""
    own = items.select(F.col(item_col).alias("item_id"), words(F.col(item_text_col)).alias("w")).distinct()
    own = own.select("item_id", F.size("w").alias("n_words"), shingles(F.col("w")).alias("shingles")).where("shingles is not null")
    own = stage(own.withColumn("item", F.xxhash64("item_id", "shingles")))
    least = F.ceil(F.size("shingles") * percent / 100).cast("int")
    wanted = own.select("item", "n_words", F.size("shingles").alias("m"), least.alias("t"), F.explode(F.array_distinct("shingles")).alias("h"))
    few_items = _few(wanted)

    texts = docs.select(row_key(id_col, text_col).alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # Words are a column of their own: inside the lambda they would be cut again for every shingle.
    cut = texts.select("row", words(F.col("text")).alias("w"))
    # An inner explode would filter on the size of the array first, with the same effect.
    placed = cut.select("row", F.posexplode_outer(shingles(F.col("w"))).alias("p", "h")).where("h is not null")
    hits = _join(placed, wanted, ["h"], few_items).groupBy("row", "item", "n_words", "m", "t").agg(F.sort_array(F.collect_set("p")).alias("p"))
    hits = hits.where(F.size("p") >= F.col("t"))
    # Windows that hold the i-th to the (i + t - 1)-th shared shingle.
    last = lambda i: F.element_at("p", i + F.col("t"))
    first = lambda i: F.element_at("p", i + 1)
    near = F.filter(F.sequence(F.lit(0), F.size("p") - F.col("t")), lambda i: last(i) - first(i) < F.col("m"))
    starts = F.flatten(F.transform(near, lambda i: F.sequence(F.greatest(last(i) - F.col("m") + 1, F.lit(0)), first(i))))
    wide = stage(hits.where(F.size(near) > 0).select("row", "n_words", "m", F.explode(F.array_distinct(starts)).alias("start")).distinct())

    spots = stage(wide.groupBy("row").agg(F.collect_list(F.struct("n_words", "m", "start")).alias("spots")))
    cut = _join(texts, spots, ["row"], _few(spots)).select("row", "doc_id", "spots", words(F.col("text")).alias("w"))
    cut = cut.select("row", "doc_id", "spots", shingles(F.col("w")).alias("all"))
    cut = cut.select("row", "doc_id", "all", F.size("all").alias("n_all"), F.explode("spots").alias("s"))
    # A window at the end of the document starts earlier.
    start = F.greatest(F.least(F.col("s.start"), F.col("n_all") - F.col("s.m")), F.lit(0))
    cut = cut.select("row", "doc_id", F.col("s.n_words").alias("n_words"), start.alias("start"), F.slice("all", start + 1, F.col("s.m")).alias("shingles"))
    windows = stage(cut.dropDuplicates(["row", "n_words", "start"]))

    keys = ["row", "n_words", "start"]
    prints = stage(simhash(windows, keys))
    item_prints = simhash(own, ["item", "n_words"])
    blocks = lambda c: F.explode(F.array(*(F.struct(F.lit(b).alias("b"), block(F.col("fingerprint"), b).alias("v")) for b in range(BLOCKS)))).alias(c)
    flips = F.array(*(F.lit(x) for x in FLIPS))
    item_blocks = item_prints.select("item", "n_words", F.col("fingerprint").alias("item_print"), blocks("k"))
    item_blocks = item_blocks.select("item", "n_words", "item_print", F.col("k.b").alias("b"), F.explode(F.transform(flips, lambda x: x.bitwiseXOR(F.col("k.v")))).alias("v"))
    met = _join(prints.select(*keys, "fingerprint", blocks("k")).select(*keys, "fingerprint", F.col("k.b").alias("b"), F.col("k.v").alias("v")),
                item_blocks, ["n_words", "b", "v"], _few(item_blocks))
    close = met.where(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_print"))) <= RADIUS).select(*keys, "item").distinct()

    both = close.join(windows, keys)
    both = _join(both, own.select("item", "item_id", F.col("shingles").alias("item_shingles")), ["item"], few_items)
    shared = overlap(F.col("shingles"), F.col("item_shingles"))
    total = F.size("shingles") + F.size("item_shingles")
    judged = both.select("row", "doc_id", "item_id", "start", "n_words", shared.alias("o"), total.alias("total"))
    judged = judged.where(100 * F.col("o") >= percent * (F.col("total") - F.col("o")))
    judged = judged.withColumn("similarity", F.col("o") / (F.col("total") - F.col("o")))
    best = F.max_by(F.struct("start", "n_words", "similarity"), F.struct("similarity", -F.col("start")))
    return judged.groupBy("row", "doc_id", "item_id").agg(best.alias("w")).select("row", "doc_id", "item_id", "w.start", "w.n_words", "w.similarity")


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    return F.xxhash64(F.lit(7), id_col, text_col)


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that match an item."""
    found = stage(matches(docs, items, id_col, text_col).select(F.col("row").alias("_row")).distinct())
    keyed = docs.withColumn("_row", row_key(id_col, text_col))
    return keyed.join(F.broadcast(found) if _few(found) else found, "_row", "left_anti").select(*docs.columns)
