"""All documents whose sets of word n-grams have a Jaccard similarity of at least a threshold, as connected classes.

Equal sets are one node. Two sets of sizes ``n`` and ``m`` link when ``overlap >= t / (1 + t) * (n + m)``, so an overlap of ``t * n`` is
needed whatever the partner, and each set shares one of its ``n - ceil(t * n) + 1`` first n-grams, in any order common to all sets, with
every partner. The order puts frequent n-grams last (counts from a sketch of fixed size, ties by hash), so the lists of
the first n-grams are short and a passage shared by many documents does not bring them together.

Lists with the same smallest member are one group, whose members meet as those of its lists would. The groups are searched three times. First each member
meets the smallest members of its groups, up to ``STARS`` of them, which gives most classes. Then, in the
groups whose members are in several classes, members of different classes meet: a group is dealt out in
blocks of about ``BLOCK`` members, and pairs of blocks are compared inside tasks, so that no table of all pairs arises; members in the class of the
group's smallest member are not compared with each other. Of the pairs that meet, those go on whose sizes allow a link and whose parity bitmaps differ in
no more bits than linked sets can differ in n-grams, which loses none: nearly all others are left out. In the second search a member goes on with the
``NEAREST`` ones of a block only, which joins most classes; in the third with all that are then still in other classes.

Pairs that are left are grouped by one side, the query. A task builds the inverted lists of the query's n-grams over the sets of up to ``CHUNK`` members
and searches them by DivideSkip: the longest lists are set aside, the short ones are merged by a heap, which skips the members that cannot reach the
required overlap less the number of long lists, and the others are looked up in the long lists by binary search. Members with the required overlap
are links.

A null text, or one without words, is an empty set and links with nothing. A text with fewer words than ``n`` has its whole sequence as
one n-gram. Rows with equal ids count as documents of their own and link by their texts. Rows with a null id share the class of the documents with an
equal set; a set that only they hold links with nothing, and its class id is null. Columns beside id and text are ignored.
Sets are compared by 64-bit hashes of n-grams, and equal sets meet by a 64-bit hash of their hashes.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldloom.llm.components import connected
from foldloom.llm.words import mix, shingle_sets, slices
from foldloom.session import bound_batches
from foldloom.storage import stage

SKETCH_BITS = 22
SKETCH_ROWS = 64
CHUNK = 256
BLOCK = 256
STARS = 8
NEAREST = 2
BROADCAST_ROWS = 1_000_000


def set_hash(own: np.ndarray) -> int:
    """One signed number for a set of hashes."""
    total = mix(own ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64) + np.uint64(len(own))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def bitmap(own: np.ndarray) -> bytes:
    """For each of about twice as many bits as n-grams, whether an odd number of n-grams falls on it."""
    bits = max(64, 1 << int(2 * len(own) - 1).bit_length())
    odd = np.bincount(((own >> np.uint64(7)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def bits_apart(a: bytes, b: bytes) -> int:
    """In how many bits two bitmaps differ, at most the number of n-grams in one set only; the longer is folded first."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def ceil_share(n: int, percent: int) -> int:
    return -(-n * percent // 100)


def needed(n, m, percent: int):
    """The smallest overlap with which sets of these sizes link: ``100 * overlap >= percent * (n + m - overlap)``."""
    return -(-percent * (n + m) // (100 + percent))


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """``doc_id, n_shingles, sig, bits`` per document, and the parts of each task's sketch under ``part, counts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.uint8)
        names = ["doc_id", "n_shingles", "sig", "bits", "part", "counts"]
        for whole in batches:
            for batch in slices(whole, "text"):
                sizes, sigs, bits, all_sets = [], [], [], []
                for own in shingle_sets(batch.column("text"), n):
                    sizes.append(len(own))
                    sigs.append(set_hash(own) if len(own) else None)
                    bits.append(bitmap(own) if len(own) else None)
                    all_sets.append(own)
                slots = (np.concatenate(all_sets) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
                slots, more = np.unique(slots, return_counts=True)
                sketch[slots] = np.minimum(sketch[slots] + more, 255)
                nulls = [pa.nulls(len(sizes), t) for t in (pa.int32(), pa.binary())]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(sigs, pa.int64()), pa.array(bits, pa.binary()), *nulls], names)
        if sketch.any():
            parts = sketch.reshape(SKETCH_ROWS, -1)
            nulls = [*(pa.nulls(SKETCH_ROWS, pa.int64()) for _ in range(3)), pa.nulls(SKETCH_ROWS, pa.binary())]
            counts = pa.array([p.tobytes() for p in parts], pa.binary())
            yield pa.RecordBatch.from_arrays([*nulls, pa.array(range(SKETCH_ROWS), pa.int32()), counts], names)

    return docs.mapInArrow(run, "doc_id bigint, n_shingles bigint, sig bigint, bits binary, part int, counts binary")


def _sketch(parts: DataFrame) -> np.ndarray:
    """The counts of all tasks, summed part by part; its size does not depend on the data."""

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(counts, np.uint8).astype(np.uint32)
                sums[part] = sums[part] + own if part in sums else own
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["part", "counts"]
        )

    rows = parts.repartition(SKETCH_ROWS, "part").mapInArrow(add, "part int, counts binary").collect()
    out = np.zeros((SKETCH_ROWS, (1 << SKETCH_BITS) // SKETCH_ROWS), np.uint16)
    for part, counts in rows:
        out[part] = np.minimum(np.frombuffer(counts, np.uint32), 65535)
    return out.reshape(-1)


def _postings(docs: DataFrame, n: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """``shingle, sig``: the first n-grams of every set, rare ones first; equal sets in a task give them once."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = shared.value, set()
        for whole in batches:
            for batch in slices(whole, "text"):
                keys, sigs = [], []
                for own in shingle_sets(batch.column("text"), n):
                    sig = set_hash(own) if len(own) else None
                    if sig is None or sig in seen:
                        continue
                    seen.add(sig)
                    rank = counts[(own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                    first = own[np.argsort(rank, kind="stable")[: len(own) - ceil_share(len(own), percent) + 1]]
                    keys.append(first)
                    sigs.append(np.full(len(first), sig, np.int64))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(sigs))], ["shingle", "sig"])

    return docs.select("text").mapInArrow(run, "shingle bigint, sig bigint")


def t_occurrence(query: np.ndarray, members: list[np.ndarray], percent: int) -> list[int]:
    """Places of the members that link with the query, by DivideSkip over inverted lists of the query's n-grams."""
    sizes = np.array([len(m) for m in members])
    required = needed(len(query), sizes, percent)
    fit = np.flatnonzero(required <= np.minimum(sizes, len(query)))
    if not len(fit):
        return []
    grams = np.concatenate([members[i] for i in fit])
    owner = np.repeat(np.arange(len(fit)), sizes[fit])
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order].tolist()
    low, high = np.searchsorted(grams, query, "left"), np.searchsorted(grams, query, "right")
    lists = sorted((owner[i:j] for i, j in zip(low.tolist(), high.tolist(), strict=True) if i < j), key=len, reverse=True)
    needs = required[fit].tolist()
    least = min(needs)
    # As many long lists as balance merging against probing: T / (mu * log2 of the longest list + 1).
    n_long = min(least - 1, int(least / (0.1 * np.log2(max(2, len(lists[0]) if lists else 2)) + 1)))
    found = []
    for member, count in merge_skip(lists[n_long:], least - n_long):
        for n_left, postings in zip(range(n_long, 0, -1), lists[:n_long], strict=False):
            if count >= needs[member] or count + n_left < needs[member]:
                break
            at = bisect_left(postings, member)
            count += at < len(postings) and postings[at] == member
        if count >= needs[member]:
            found.append(int(fit[member]))
    return found


def merge_skip(lists: list[list[int]], least: int) -> Iterator[tuple[int, int]]:
    """The values that are in ``least`` of the ascending lists or more, ascending, with the number of lists that hold them. A value that is not
    costs no look at the values of the other lists before the next one that can be."""
    at = [0] * len(lists)
    heap = [(own[0], i) for i, own in enumerate(lists)]
    heapify(heap)
    while len(heap) >= least:
        value, popped = heap[0][0], []
        while heap and heap[0][0] == value:
            popped.append(heappop(heap)[1])
        if len(popped) >= least:
            yield value, len(popped)
            bound = value + 1
        else:
            # Fewer lists than needed begin before the next value that counts.
            while heap and len(popped) < least - 1:
                popped.append(heappop(heap)[1])
            if not heap:
                return
            bound = heap[0][0]
        for i in popped:
            at[i] = bisect_left(lists[i], bound, at[i])
            if at[i] < len(lists[i]):
                heappush(heap, (lists[i][at[i]], i))


def _routed(docs: DataFrame, routes: DataFrame, n: int) -> DataFrame:
    """``a, chunk, b, grams``: the sets of nodes where they are wanted (``rep, sig, a, chunk, b``). The texts of their
    representatives are found by id and hashed again; the routes are broadcast if there are few."""
    few = routes.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    routes = routes.withColumnRenamed("rep", "doc_id")
    found = docs.join(F.broadcast(routes) if few else routes, "doc_id").select("a", "chunk", "b", "sig", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                keep, grams = [], []
                for i, (sig, own) in enumerate(zip(batch.column("sig").to_pylist(), shingle_sets(batch.column("text"), n), strict=True)):
                    if len(own) and set_hash(own) == sig:
                        keep.append(i)
                        grams.append(own.tobytes())
                own = [batch.column(c).take(pa.array(keep, pa.int64())) for c in ("a", "chunk", "b")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(grams, pa.binary())], ["a", "chunk", "b", "grams"])

    return found.mapInArrow(run, "a bigint, chunk int, b bigint, grams binary")


def _search(docs: DataFrame, pairs: DataFrame, nodes: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` that link. ``a`` is the query; its members are dealt out in chunks, each with the query's set."""
    counts = pairs.groupBy("a").agg(F.count("*").alias("n"))
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    members = pairs.join(counts, "a").select("a", F.pmod(F.xxhash64("b"), chunks).cast("int").alias("chunk"), "b", F.col("b").alias("sig"))
    queries = counts.select("a", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"), F.lit(None).cast("bigint").alias("b"), F.col("a").alias("sig"))
    routes = stage(queries.unionAll(members).join(nodes.select("sig", "rep"), "sig").select("rep", "sig", "a", "chunk", "b"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _routed(docs, routes, n).repartition(parts, "a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, query, ids, held = None, None, [], []

        def links():
            found = t_occurrence(query, held, percent) if query is not None and held else []
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]] * len(found), pa.int64()), pa.array([ids[i] for i in found], pa.int64())], ["a", "b"]
            )

        for batch in batches:
            for a, chunk, b, grams in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != (a, chunk):
                    if key is not None:
                        yield links()
                    key, query, ids, held = (a, chunk), None, [], []
                own = np.frombuffer(grams, np.uint64)
                if b is None:
                    query = own
                else:
                    ids.append(b)
                    held.append(own)
        if key is not None:
            yield links()

    return rows.mapInArrow(run, "a bigint, b bigint")


def _may_link(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sizes and bitmaps allow a link."""
    for side in "ab":
        own = nodes.select(F.col("sig").alias(side), F.col("size").alias(f"size_{side}"), F.col("bits").alias(f"bits_{side}"))
        pairs = pairs.join(own, side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("size_a", "size_b", "bits_a", "bits_b"))
            keep = [n + m - bits_apart(x, y) >= 2 * needed(n, m, percent) for n, m, x, y in zip(*columns, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    close = pairs.where(100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b"))
    return close.select("a", "b", "size_a", "size_b", "bits_a", "bits_b").mapInArrow(run, "a bigint, b bigint")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    bound_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    staged = stage(_sets(docs, n))
    sets = staged.where("part is null").select("doc_id", "n_shingles", "sig")
    sketch = _sketch(staged.where("part is not null").select("part", "counts"))
    nodes = sets.where("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("size"))

    dealt = _postings(docs, n, percent, sketch).repartition("shingle")
    shared = dealt.groupBy("shingle").agg(F.min("sig").alias("lo"), F.max("sig").alias("hi")).where("lo <> hi").select("shingle", "lo")
    groups = stage(dealt.join(shared.hint("shuffle_hash"), "shingle").select("lo", "sig").distinct())
    bits = staged.where("sig is not null").groupBy("sig").agg(F.max("bits").alias("bits"))
    involved = stage(nodes.join(groups.select("sig").distinct(), "sig").join(bits, "sig").where("rep is not null"))

    stars = groups.where("sig <> lo").groupBy("sig").agg(F.array_sort(F.collect_set("lo")).alias("los"))
    pairs = stars.select(F.explode(F.slice("los", 1, STARS)).alias("a"), F.col("sig").alias("b"))
    tested = stage(_may_link(pairs, involved, percent))
    links = stage(_search(docs, tested, involved, n, percent))
    labels = stage(connected(links))
    for nearest in (NEAREST, None):
        more = stage(_across(groups, labels, involved, percent, nearest).distinct().join(tested, ["a", "b"], "left_anti"))
        if not more.isEmpty():
            tested = tested.unionAll(more)
            links = links.unionAll(stage(_search(docs, more, involved, n, percent)))
            labels = stage(connected(links))
    named = nodes.join(labels.withColumnRenamed("node", "sig"), "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    ids = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    classes = named.join(ids, "component").select("sig", "component_id")
    return sets.join(classes, "sig", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` for each class: the one with the class's id. Of repeated rows with that id one stays, a row
    without words is a class of its own unless its id is repeated, and rows without an id stay if their class has none."""
    classes = jaccard_join(docs, id_col, text_col, n, percent)
    kept = stage(classes.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_kept")).where("_kept is not null").distinct())
    few = kept.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    rows = docs.join(F.broadcast(kept) if few else kept, docs[id_col] == F.col("_kept"), "left")
    rows = rows.where(F.col("_kept").isNotNull() | F.col(id_col).isNull()).drop("_kept")
    return rows


def _across(groups: DataFrame, labels: DataFrame, nodes: DataFrame, percent: int, nearest: int | None) -> DataFrame:
    """Pairs ``a, b`` of members of one group that are in different classes and may link; of a member, those with the ``nearest`` in a
    block, if that is a number."""
    known = groups.join(labels.withColumnRenamed("node", "sig"), "sig", "left").withColumn("class", F.coalesce("component", "sig"))
    main = known.where("sig = lo").select("lo", F.col("class").alias("main"))
    known = known.join(main, "lo").withColumn("other", F.col("class") != F.col("main"))
    counts = known.groupBy("lo").agg(F.count("*").alias("all"), F.count_if("other").alias("others")).where("others > 0")
    known = stage(known.join(counts, "lo"))

    n_main, n_other = F.ceil((F.col("all") - F.col("others")) / BLOCK).cast("int"), F.ceil(F.col("others") / BLOCK).cast("int")
    rows = known.withColumn("n_main", n_main).withColumn("n_other", n_other)
    # Blocks of the main class have the numbers below n_main; a row goes to every pair of blocks that holds its own and one of the others.
    place = F.xxhash64("sig", F.lit(3))
    own = F.when(F.col("other"), F.col("n_main") + F.pmod(place, "n_other")).otherwise(F.pmod(place, "n_main")).cast("int")
    partners = F.sequence(F.when(F.col("other"), 0).otherwise(F.col("n_main")), F.col("n_main") + F.col("n_other") - 1)
    rows = rows.withColumn("own", own).withColumn("partner", F.explode(partners))
    rows = rows.select("lo", F.least("own", "partner").alias("i"), F.greatest("own", "partner").alias("j"), "own", "class", "sig")
    group = ["lo", "i", "j"]
    parts = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.join(nodes.select("sig", "size", "bits"), "sig").repartition(parts, *group).sortWithinPartitions(*group, "own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def pairs():
            i, j = key[1:]
            left, right = ([r for r in held if r[0] == number] for number in (i, j))
            a, b = block_pairs(left, right if j != i else None, percent, nearest)
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], ["a", "b"])

        for batch in batches:
            for *own_key, own, cls, sig, size, bits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own_key != key:
                    if key:
                        yield pairs()
                    key, held = own_key, []
                held.append((own, cls, sig, size, bits))
        if key:
            yield pairs()

    return rows.select(*group, "own", "class", "sig", "size", "bits").mapInArrow(run, "a bigint, b bigint")


def block_pairs(left: list[tuple], right: list[tuple] | None, percent: int, nearest: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows ``own, class, sig, size, bits`` of two blocks, or inside one, that are in different classes and may link. With ``nearest``, for each
    row of the first block those with the rows that differ least."""
    other = left if right is None else right
    sizes, classes, sigs = (np.array([r[i] for r in other], np.int64) for i in (3, 1, 2))
    by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for length in {len(r[4]) for r in other}:
        at = np.array([i for i, r in enumerate(other) if len(r[4]) == length])
        by_length[length] = at, np.frombuffer(b"".join(other[i][4] for i in at), np.uint64).reshape(len(at), -1)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, (_, cls, sig, size, bits) in enumerate(left):
        own, found, slack = np.frombuffer(bits, np.uint64), [], []
        for at, rows in by_length.values():
            keep = (classes[at] != cls) & (100 * np.minimum(sizes[at], size) >= percent * np.maximum(sizes[at], size))
            if right is None:
                keep &= at > i
            at, rows, query = at[keep], rows[keep], own
            if not len(at):
                continue
            while rows.shape[1] > len(query):
                rows = rows[:, : rows.shape[1] // 2] ^ rows[:, rows.shape[1] // 2 :]
            while len(query) > rows.shape[1]:
                query = query[: len(query) // 2] ^ query[len(query) // 2 :]
            apart = np.bitwise_count(rows ^ query).sum(1, dtype=np.int64)
            more = size + sizes[at] - apart - 2 * needed(size, sizes[at], percent)
            found.append(at[more >= 0])
            slack.append(more[more >= 0])
        if not found:
            continue
        near = np.concatenate(found)
        if nearest is not None:
            near = near[np.argsort(-np.concatenate(slack), kind="stable")[:nearest]]
        a.append(np.full(len(near), sig, np.int64))
        b.append(sigs[near])
    return np.concatenate(a), np.concatenate(b)
