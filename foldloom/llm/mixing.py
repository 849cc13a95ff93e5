"""Mixing of sources to target weights by Pfair scheduling.

Rows of a source are put in a seeded order and cut into blocks. While all sources have rows, a source with weight ``w`` of a total ``W`` is owed ``t * w / W``
blocks by slot ``t``; when one has been owed all of its blocks, the others share its slots in proportion, and no row is dropped. Block ``j`` is released in
the slot in which the source is first owed more than ``j`` blocks, and its deadline is the slot by which it is owed ``j + 1``. Each slot takes the released
block with the earliest deadline. What is owed sums up to the slots that have passed, so a schedule that keeps all deadlines exists, and this one
finds it: before every slot each source has had less than one block more or less than it is owed, for the weights as given. Releases and deadlines
are computed in whole numbers from the exact values of the weights.

The driver holds one number of rows per source, for up to ``MAX_SOURCES`` sources (more are refused), and one slot per block. Blocks have 100 rows, or as many
more as it takes to have no more than ``MAX_BLOCKS`` of them beside the last one of each source; rows never pass through the driver.

A null source is a source of its own. Sources without a weight above zero are an error; weights of sources without rows are ignored. The order within a source is that of a
hash of the id, the same whatever the partitions; rows of an id (or of no id) that has more than ``HEAVY_ROWS`` of a source come last in it, in any order, and are
dealt out to many tasks. Repeated rows take places of their own. An empty table gives an empty result. Columns of the input are kept whatever their names;
the results ``block``, ``slot`` and ``place`` replace columns of the same name.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Mapping
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldloom.storage import stage

BLOCK_ROWS = 100
MAX_BLOCKS = 1_000_000
MAX_SOURCES = 1_000_000
BUCKET_ROWS = 1000
BUCKETS = 1000
HEAVY_ROWS = 10_000
SEED = 42


class Owed:
    """How many blocks all sources together have been given when source ``i`` is owed ``j``: the time of that as ``first`` whole slot and ``last``."""

    def __init__(self, blocks: list[int], weights: list[int]):
        self.blocks, self.weights = blocks, weights
        ends = sorted(range(len(blocks)), key=lambda i: Fraction(blocks[i], weights[i]))
        self.ends, self.near = ends, [blocks[i] / weights[i] for i in ends]
        # Blocks of the sources that have ended, and the weight of the others.
        self.given, self.left = [0], [sum(weights)]
        for i in ends:
            self.given.append(self.given[-1] + blocks[i])
            self.left.append(self.left[-1] - weights[i])

    def _ended_before(self, k: int, i: int, j: int) -> bool:
        end = self.ends[k]
        return self.blocks[end] * self.weights[i] < j * self.weights[end]

    def time(self, i: int, j: int) -> tuple[int, int]:
        """The time rounded down and up."""
        k = bisect_left(self.near, j / self.weights[i])
        while k and not self._ended_before(k - 1, i, j):
            k -= 1
        while k < len(self.ends) and self._ended_before(k, i, j):
            k += 1
        work, weight = j * self.left[k], self.weights[i]
        return self.given[k] + work // weight, self.given[k] - (-work // weight)


def whole(weights: list[float]) -> list[int]:
    """Whole numbers in the exact proportion of the weights."""
    exact = [Fraction(w) for w in weights]
    scale = math.lcm(*(w.denominator for w in exact))
    return [int(w * scale) for w in exact]


def schedule(blocks: list[int], weights: list[float]) -> list[list[int]]:
    """The slots of each source's blocks, earliest deadline first. Every source has a block and a weight above zero."""
    owed = Owed(blocks, whole(weights))
    slots: list[list[int]] = [[] for _ in blocks]
    waiting = [(0, owed.time(i, 1)[1], i, 0) for i in range(len(blocks))]  # release, deadline, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []  # deadline, source, block
    for slot in range(sum(blocks)):
        while waiting and waiting[0][0] <= slot:
            heapq.heappush(ready, heapq.heappop(waiting)[1:])
        _, i, j = heapq.heappop(ready)
        slots[i].append(slot)
        if j + 1 < blocks[i]:
            heapq.heappush(waiting, (owed.time(i, j + 1)[0], owed.time(i, j + 2)[1], i, j + 1))
    return slots


def _numbered(rows: DataFrame, n_buckets: int) -> DataFrame:
    """Add ``_index``, the place of a row in its source, to ``_in, _source, _order``. Whole rows are dealt out once."""
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())
    heavy = stage(rows.groupBy("_source", "_order").agg(F.count("*").alias("_n")).where(F.col("_n") > HEAVY_ROWS))
    # At most one row for every HEAVY_ROWS rows.
    extra = heavy.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.count("*")).first()
    bucket = F.pmod(F.shiftrightunsigned("_order", 3), F.lit(n_buckets))
    if extra[1]:
        known = heavy.select("_source", "_order", F.lit(True).alias("_heavy"))
        rows = rows.join(F.broadcast(known) if extra[1] <= BUCKETS else known, ["_source", "_order"], "left")
        last = n_buckets + F.pmod(F.xxhash64("_order", "_tie"), F.lit(-(-extra[0] // BUCKET_ROWS)))
        bucket = F.when(F.col("_heavy"), last).otherwise(bucket)
    inside = Window.partitionBy("_source", "_bucket").orderBy("_order", "_tie")
    ranked = stage(rows.withColumn("_bucket", bucket).select("_in", "_source", "_bucket", (F.row_number().over(inside) - 1).alias("_rank")))
    counts = ranked.groupBy("_source", "_bucket").agg(F.count("*").alias("_n")).withColumn("_part", F.floor(F.col("_bucket") / BUCKETS))
    parts = counts.groupBy("_source", "_part").agg(F.sum("_n").alias("_n"))
    before = lambda key, order: F.sum("_n").over(Window.partitionBy(*key).orderBy(order)) - F.col("_n")
    starts = parts.select("_source", "_part", before(["_source"], "_part").alias("_start"))
    offsets = counts.withColumn("_within", before(["_source", "_part"], "_bucket")).join(starts, ["_source", "_part"])
    offsets = offsets.select("_source", "_bucket", (F.col("_start") + F.col("_within")).alias("_offset"))
    return ranked.join(offsets, ["_source", "_bucket"]).select("_in", "_source", (F.col("_offset") + F.col("_rank")).alias("_index"))


def mix_sources(
    docs: DataFrame, weights: Mapping[str | None, float] | None = None, source_col: str = "source", id_col: str = "doc_id",
    block_rows: int | None = None,
) -> DataFrame:
    """``docs`` with ``block`` (of the source), ``slot`` (of the mixture) and ``place`` (in the block). Reading by slot and place
    gives the mixture. Without weights a source weighs the square root of its rows."""
    spark = docs.sparkSession
    own = {c: docs["`" + c.replace("`", "``") + "`"] for c in docs.columns}
    kept = F.struct(*[own[c].alias(c) for c in docs.columns if c not in ("block", "slot", "place")])
    key = F.coalesce(F.concat(F.lit("="), own[source_col].cast("string")), F.lit(""))
    rows = docs.select(kept.alias("_in"), key.alias("_source"), F.xxhash64(F.lit(SEED), own[id_col]).alias("_order"))
    found = rows.groupBy("_source").agg(F.count("*").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sizes = dict(sorted((r[0], r[1]) for r in found))
    if weights is None:
        named = {k: n**0.5 for k, n in sizes.items()}
    else:
        given = {"" if k is None else f"={k}": w for k, w in weights.items()}
        if missing := [k for k in sizes if not given.get(k, 0) > 0]:
            raise ValueError(f"no weight for {missing}")
        named = {k: given[k] for k in sizes}
    total = sum(sizes.values())
    block_rows = block_rows or max(BLOCK_ROWS, -(-total // MAX_BLOCKS))
    slots = schedule([-(-n // block_rows) for n in sizes.values()], list(named.values())) if sizes else []
    # One number per block.
    plan = spark.createDataFrame(pa.table({"_source": pa.array(list(sizes), pa.string()), "_slots": pa.array(slots, pa.list_(pa.int64()))}))

    placed = _numbered(rows, max(1, -(-total // BUCKET_ROWS))).withColumn("block", F.floor(F.col("_index") / block_rows))
    joined = placed.join(F.broadcast(plan), "_source")
    slot = F.element_at("_slots", (F.col("block") + 1).cast("int"))
    return joined.select("_in.*", "block", slot.alias("slot"), (F.col("_index") % block_rows).alias("place"))
