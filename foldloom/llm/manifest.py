"""A Merkle manifest of a table: leaves per row, one tree per group, one tree over the groups' roots, and a proof for every row.

Leaves of a group stand in key order and have slots 0, 1, ... Slots come from a range sort into many tasks and the counts
per task and group, so a group with most of the rows is spread over all tasks. A tree is built in rounds of ``LEVELS`` levels: a round
deals slots out in blocks of ``2 ** LEVELS``, and inside a block works level by level on one window in slot order. At level ``l`` the nodes
stand on the rows whose slot is a multiple of ``2 ** l``; ``lead`` and ``lag`` by ``2 ** l`` rows, masked by slot and by the number of nodes left, give
a node its sibling, and the rows of first children hash the parents. All levels of a round share one shuffle. The first nodes of the blocks are the rows
of the next round, a thousandth as many. Paths go down the same rounds by joins on group and block, which the rows of a round are dealt by already.

Texts are read once, to hash them, and are never shuffled.

Null values are hashed as ``-``; rows with a null group form a group of their own, which comes first. Rows with a null key come first in their group.
Rows with equal keys stand in the order of their leaves; equal rows have equal leaves, so their places can be exchanged without a change
of any digest. A null key is never tampered with. An empty table gives an empty table. Columns that are not named as fields are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldloom.storage import stage

LEVELS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BROADCAST_ROWS = 100_000
_PATH = "array<struct<side:int,hash:string>>"


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value; integers in decimal digits."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to. A step has its sibling at the right (1), at the left (-1) or has none (0)."""

    def step(node: Column, at: Column) -> Column:
        pair = F.when(at["side"] == 1, F.concat(node, at["hash"])).when(at["side"] == -1, F.concat(at["hash"], node)).otherwise(node)
        return F.sha2(pair.cast("binary"), 256)

    return F.aggregate(path, leaf, step)


def _slots(nodes: DataFrame, order: Sequence[str], folder: str) -> DataFrame:
    """Add ``slot``, the place in the order of the columns ``order`` inside each ``tree``, and ``nodes``, the size of the tree."""
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = nodes.withColumn("_tie", F.monotonically_increasing_id())
    ranged = placed.repartitionByRange(parts, "tree", *order, "_tie").sortWithinPartitions("tree", *order, "_tie").drop("_tie")
    # The id counts the rows of a task in the order in which they stand.
    ranged = stage(ranged.withColumn("_at", F.monotonically_increasing_id()).withColumn("_task", F.shiftright("_at", 33)), folder)
    runs = ranged.groupBy("tree", "_task").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    whole = Window.partitionBy("tree")
    before = F.sum("_n").over(whole.orderBy("_task")) - F.col("_n")
    # As many rows as tasks and trees together.
    runs = stage(runs.select("tree", "_task", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("nodes")), folder)
    few = runs.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    joined = ranged.join(F.broadcast(runs) if few else runs, ["tree", "_task"])
    return joined.withColumn("slot", F.col("_at") + F.col("_shift")).drop("_at", "_task", "_shift")


def _round(nodes: DataFrame, levels: int) -> DataFrame:
    """Add to ``tree, slot, nodes, hash`` the ``block``, the ``path`` inside it, and on the first row of a block its node, ``top``."""
    inside = Window.partitionBy("tree", "block").orderBy("slot")
    rows = nodes.withColumn("block", F.shiftright("slot", LEVELS)).withColumn("_h0", F.col("hash"))
    steps = []
    for level in range(levels):
        width, own = 1 << level, F.col(f"_h{level}")
        standing = F.col("slot") % width == 0
        left = F.col("slot") % (2 * width) == 0
        # Nodes of the whole tree at this level; one that is left alone is the root and goes up as it is.
        alone = F.col("nodes") <= width
        before, after = F.lag(own, width).over(inside), F.lead(own, width).over(inside)
        rows = rows.withColumn("_step", F.when(standing & ~alone, F.when(left, F.struct(F.when(after.isNull(), 0).otherwise(1).alias("side"), after.alias("hash"))).otherwise(F.struct(F.lit(-1).alias("side"), before.alias("hash")))))
        parent = F.when(alone, own).otherwise(digest(own, F.coalesce(F.col("_step.hash"), F.lit(""))))
        rows = rows.withColumn(f"_h{level + 1}", F.when(left, parent)).withColumnRenamed("_step", f"_s{level}")
        # A row sees the step of the node above it on the last row that holds one.
        steps.append(F.last(f"_s{level}", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    path = F.filter(F.array(*steps), lambda s: s.isNotNull()).cast(_PATH)
    rows = rows.withColumn("path", path).withColumn("top", F.col(f"_h{levels}"))
    return rows.drop(*[f"_h{i}" for i in range(levels + 1)], *[f"_s{i}" for i in range(levels)])


def _forest(nodes: DataFrame, order: Sequence[str], folder: str) -> tuple[list[DataFrame], DataFrame]:
    """The rounds from the leaves up, each with ``tree, slot, block, path``, and ``tree, subroot``."""
    rows, rounds = _slots(nodes, order, folder), []
    largest = rows.agg(F.max("nodes")).first()[0] or 0
    while True:
        # No more levels than the largest tree has left.
        done = stage(_round(rows, max(1, min(LEVELS, (largest - 1).bit_length()))), folder)
        rounds.append(done.drop("top", "nodes"))
        tops = done.where(F.col("top").isNotNull())
        largest = -(-largest >> LEVELS)
        if largest <= 1:
            return rounds, tops.select("tree", F.col("top").alias("subroot"))
        rows = tops.select(
            "tree", F.col("block").alias("slot"), F.ceil(F.col("nodes") / (1 << LEVELS)).cast("bigint").alias("nodes"), F.col("top").alias("hash")
        )


def _down(rounds: list[DataFrame], tops: DataFrame, *columns: str) -> DataFrame:
    """Lead the columns and paths of ``tops`` (a row per tree) down to the leaves."""
    above = tops.withColumn("_slot", F.lit(0).cast("bigint"))
    for rows in reversed(rounds):
        above = above.select(F.col("tree").alias("_tree"), "_slot", F.col("path").alias("_path"), *columns)
        met = rows.join(above, (rows["tree"] == F.col("_tree")) & (rows["block"] == F.col("_slot")))
        met = met.withColumn("path", F.concat("path", "_path")).drop("_tree", "_slot", "_path", "block", "hash")
        above = met.withColumnRenamed("slot", "_slot")
    return above.drop("_slot")


def manifest(
    docs: DataFrame, folder: str, fields: Sequence[str] = FIELDS, key: str = "doc_id", group: str = "lang", counted: str = "n_chars", every: int = 7
) -> DataFrame:
    """``key, leaf, subroot, root, proof_sha256, folded_root, verified`` for every row.

    ``folded_root`` folds the leaf with the original siblings; where ``every`` divides the crc32 of the key, it is the leaf of a row whose
    ``counted`` field is one larger. Intermediate tables go to ``folder`` and are needed until the result has been written.
    """
    value = {f: docs[f"`{f}`"] for f in fields}
    plain = digest(*[encoded(value[f]) for f in fields])
    other = digest(*[encoded(value[f].cast("decimal(38,0)") + 1 if f == counted else value[f]) for f in fields])
    touched = F.coalesce(F.crc32(value[key].cast("string").cast("binary")) % every == 0, F.lit(False))
    leaves = docs.select(
        value[key].alias("key"), F.coalesce(F.concat(F.lit("="), value[group].cast("string")), F.lit("")).alias("tree"),
        plain.alias("hash"), F.when(touched, other).alias("tampered"),
    )
    leaves = stage(leaves, folder)
    rounds, subroots = _forest(leaves, ["key", "hash"], folder)

    # The tree over the groups: null first, then by the bytes of the name, which is the order of "" and "=name".
    one = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("_group"), F.col("subroot").alias("hash"), "subroot")
    over, roots = _forest(one, ["_group"], folder)
    over[0] = over[0].withColumnRenamed("hash", "_own")
    tops = roots.select("tree", F.col("subroot").alias("root"), F.array().cast(_PATH).alias("path"))
    groups = _down(over, tops, "root").select(F.col("_group").alias("tree"), "subroot", "root", "path")

    rows = _down([rounds[0].withColumnRenamed("hash", "leaf"), *rounds[1:]], groups, "subroot", "root")
    siblings = F.transform("path", lambda s: F.coalesce(s["hash"], F.lit("")))
    out = rows.select(
        F.col("key").alias(key), "leaf", "subroot", "root", F.sha2(F.array_join(siblings, "").cast("binary"), 256).alias("proof_sha256"),
        fold(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle(fields: Sequence[str] = FIELDS, every: int = 7) -> str:
    """The same manifest of ``documents`` as DuckDB SQL: levels by a recursive query, crc32 bit by bit."""

    def part(expression: str) -> str:
        return f"coalesce(strlen({expression})::varchar || ':' || {expression}, '-')"

    plain = " || ".join(part(f"{f}::varchar") for f in fields)
    other = " || ".join(part("(n_chars::hugeint + 1)::varchar" if f == "n_chars" else f"{f}::varchar") for f in fields)
    return f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS row_no, doc_id, coalesce('=' || lang, '') AS tree, sha256({plain}) AS leaf, sha256({other}) AS tampered,
    list_reduce(list_concat([4294967295::bigint], flatten(list_transform(string_split(doc_id::varchar, ''), lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda crc, s: CASE WHEN s >= 0 THEN xor(crc, s) WHEN crc % 2 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END) AS crc
  FROM documents),
slots AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, row_no) - 1 AS slot, count(*) OVER (PARTITION BY tree) AS nodes FROM leaves),
levels AS (
  SELECT 0 AS level, tree, slot, nodes, leaf AS hash FROM slots
  UNION ALL
  SELECT level + 1, tree, slot // 2, (nodes + 1) // 2, sha256(string_agg(hash, '' ORDER BY slot)) FROM levels WHERE nodes > 1 GROUP BY level, tree, slot // 2, nodes),
subroots AS (SELECT tree, hash AS subroot, row_number() OVER (ORDER BY tree) - 1 AS slot, count(*) OVER () AS nodes, (SELECT max(level) FROM levels) + 1 AS base, level AS height FROM levels WHERE nodes = 1),
tops AS (
  SELECT 0 AS level, slot, nodes, subroot AS hash FROM subroots
  UNION ALL
  SELECT level + 1, slot // 2, (nodes + 1) // 2, sha256(string_agg(hash, '' ORDER BY slot)) FROM tops WHERE nodes > 1 GROUP BY level, slot // 2, nodes),
steps AS (
  SELECT s.row_no, l.level, l.slot % 2 AS place, o.hash AS sibling
  FROM slots s JOIN levels l ON l.tree = s.tree AND l.nodes > 1 AND l.slot = s.slot >> l.level
  LEFT JOIN levels o ON o.tree = s.tree AND o.level = l.level AND o.slot = xor(l.slot, 1)
  UNION ALL
  SELECT s.row_no, r.base + l.level, l.slot % 2, o.hash
  FROM slots s JOIN subroots r ON r.tree = s.tree JOIN tops l ON l.nodes > 1 AND l.slot = r.slot >> l.level
  LEFT JOIN tops o ON o.level = l.level AND o.slot = xor(l.slot, 1)),
paths AS (
  SELECT row_no, list({{'place': place, 'sibling': sibling}} ORDER BY level) AS path, string_agg(coalesce(sibling, ''), '' ORDER BY level) AS siblings FROM steps GROUP BY row_no),
folded AS (
  SELECT s.doc_id, s.leaf, r.subroot, (SELECT hash FROM tops WHERE nodes = 1) AS root, sha256(coalesce(p.siblings, '')) AS proof_sha256,
    list_reduce(list_concat([{{'place': 0::bigint, 'sibling': CASE WHEN xor(crc, 4294967295) % {every} = 0 THEN tampered ELSE leaf END}}], coalesce(p.path, [])),
      lambda node, st: {{'place': 0::bigint, 'sibling': sha256(CASE WHEN st.sibling IS NULL THEN node.sibling WHEN st.place = 0 THEN node.sibling || st.sibling ELSE st.sibling || node.sibling END)}}).sibling AS folded_root
  FROM slots s JOIN subroots r ON r.tree = s.tree LEFT JOIN paths p ON p.row_no = s.row_no)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded"""
