"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldloom.storage import stage

# Links that one task contracts; its dictionary takes a few hundred bytes for each.
TASK_LINKS = 200_000


def _contracted(edges: DataFrame, parts: int) -> DataFrame:
    """For every node that a task's share of the links names, the smallest node to which they lead. Nodes of several tasks have several rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent, kind = {}, None

        def root(node):
            top = node
            while parent.setdefault(top, top) != top:
                top = parent[top]
            while parent[node] != top:
                parent[node], node = top, parent[node]
            return top

        for batch in batches:
            kind = batch.column("u").type
            for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
                a, b = root(u), root(v)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        if parent:
            nodes = list(parent)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array([root(node) for node in nodes], kind)], ["u", "v"])

    # A session may deal out to more tasks than it is asked for, but never coalesces to more than one.
    dealt = edges.repartition(parts, "u", "v") if parts > 1 else edges.coalesce(1)
    return dealt.mapInArrow(run, edges.schema)


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node that a link between two nodes names; the component is its smallest node.

    Tasks contract up to ``TASK_LINKS`` links each, dealt out by both ends. One task's result is the answer. That of several has the same components in
    fewer and shorter chains, and large-star and small-star steps in turn join what several tasks know: each node's neighbours are hung
    on its smallest neighbour until nothing changes, which takes about as many rounds as the logarithm of the longest chain. A node with very
    many neighbours costs one partial row per task in the aggregations, and the joins split its edges. Each round is a written table.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")
    parts = -(-edges.count() // TASK_LINKS)
    contracted = _contracted(edges, max(1, parts))
    if parts <= 1:
        return contracted.select(F.col("u").alias("node"), F.col("v").alias("component"))
    edges, before = stage(contracted.where("u <> v").distinct()), None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = edges.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Every edge is seen from its smaller end: the larger end moves to the smaller end's minimum.
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m")
        )).alias("e")).select("e.u", F.col("e.m").alias("v")).where("u <> v").distinct()
        edges = stage(small)
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            return edges.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = after
