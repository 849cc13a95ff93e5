"""Near-duplicate classes by HyperMinHash sketches: banded registers, corrected estimates, then a check on full sets.

A sketch has ``BANDS * ROWS`` buckets. The n-grams of a document fall into buckets by one half of their hash; a bucket keeps its smallest value of a
second hash, compressed to 16 bits: the count of leading zeros (6 bits) and the ``MANTISSA`` bits that follow the first one. A bucket without n-grams takes the
register of the first filled bucket in an order of its own, which keeps the chance of equal registers at the Jaccard similarity for
sets smaller than the sketch. Of two sets with similarity 0.85 all 32 bands of 5 registers differ with a probability of about 7e-9.

Equal sets are one node. Nodes meet in the buckets of equal bands. Buckets are searched twice:

* every node with one node of its bucket (another one in every band), which costs one row a member and gives most classes;
* then, in buckets whose nodes are in several classes, nodes of different classes. A bucket is dealt out in blocks of at most ``BLOCK`` nodes, and
  pairs of blocks are compared inside tasks on their registers, so that no table of pairs arises. The nodes in the class of the bucket's first
  node are not compared with each other. A pair is looked at in the first band that it shares only.

A pair is a candidate if its similarity estimate, with the expected number of chance matches of compressed registers taken out, is not ``SIGMAS``
standard errors below the threshold, and if the parity bitmaps of its sets differ in no more bits than linked sets can differ in n-grams
(which loses none). Candidates are confirmed on their full sets: the texts of their first documents are found by id and hashed again.

A null text, or one without words, is an empty set and a class of its own. A text with fewer words than ``n`` has its whole sequence as one n-gram.
Rows with equal ids count as documents of their own and link by their texts. Rows with a null id share the class of the documents with
an equal set; a set that only they hold links with nothing, and its class id is null. An empty table gives an empty table. Columns beside id and text
are ignored. N-grams are compared by 64-bit hashes, sets by 128-bit hashes. The set of a single document has to fit into a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldloom.llm.components import connected
from foldloom.llm.words import mix, shingle_sets, slices
from foldloom.storage import stage

BANDS, ROWS, MANTISSA = 32, 5, 10
REGISTERS = BANDS * ROWS
SIGMAS = 5
BLOCK = 256
BROADCAST_ROWS = 200_000
# For every bucket, the order in which it looks for a filled one.
ORDERS = np.argsort(mix(np.arange(REGISTERS * REGISTERS, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D)).reshape(REGISTERS, -1), axis=1)


def compressed(values: np.ndarray) -> np.ndarray:
    """Leading zeros and the bits after the first one, in 16 bits."""
    zeros = 53 - np.frexp((values >> np.uint64(11)).astype(np.float64))[1].astype(np.uint64)
    return (zeros << np.uint64(MANTISSA) | (values << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)).astype(np.uint16)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """The sketches of sets that are not empty, one row each."""
    grams = np.concatenate(sets)
    bucket = ((grams >> np.uint64(32)) * np.uint64(REGISTERS) >> np.uint64(32)).astype(np.int64)
    least = np.full(len(sets) * REGISTERS, np.iinfo(np.uint64).max)
    np.minimum.at(least, np.repeat(np.arange(len(sets)) * REGISTERS, [len(s) for s in sets]) + bucket, mix(grams ^ np.uint64(0x2545F4914F6CDD1D)))
    least = least.reshape(len(sets), REGISTERS)
    filled = least != np.iinfo(np.uint64).max
    out, open_rows = compressed(least), np.flatnonzero(~filled.all(1))
    lacking = ~filled[open_rows]
    for source in ORDERS.T:
        if not len(open_rows):
            break
        take = lacking & filled[open_rows][:, source]
        out[open_rows] = np.where(take, out[open_rows][:, source], out[open_rows])
        lacking &= ~take
        still = lacking.any(1)
        open_rows, lacking = open_rows[still], lacking[still]
    return out


def chance_matches(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """How many registers two disjoint sets of these sizes are expected to share: mantissas are even inside a count of zeros."""
    high = 2.0 ** -np.arange(54)
    low = np.append(high[1:], 0.0)

    def shares(size):
        size = np.asarray(size, float)[:, None]
        below = (1 - low / REGISTERS) ** size - (1 - high / REGISTERS) ** size
        return below / (1 - (1 - 1 / REGISTERS) ** size)

    return REGISTERS / (1 << MANTISSA) * (shares(n) * shares(m)).sum(1)


def estimate(matches: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the number of equal registers, without the matches of chance."""
    chance = chance_matches(n, m)
    return (matches - chance) / (REGISTERS - chance)


def least_estimate(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """The estimate below which a pair of sets of these sizes is left out."""
    t = percent / 100
    return t - SIGMAS * np.sqrt(t * (1 - t) * (1 / REGISTERS + 1 / np.minimum(n, m)))


def bitmap(own: np.ndarray) -> bytes:
    """For each of about twice as many bits as n-grams, whether an odd number of n-grams falls on it."""
    bits = max(64, 1 << int(2 * len(own) - 1).bit_length())
    odd = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def bits_apart(a: bytes, b: bytes) -> int:
    """In how many bits two bitmaps differ, at most the number of n-grams in one set only; the longer is folded first."""
    x, y = sorted((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)), key=len)
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def set_hash(own: np.ndarray) -> bytes:
    """128 bits for a set of hashes."""
    sums = [mix(own ^ np.uint64(seed)).sum(dtype=np.uint64) + np.uint64(len(own)) for seed in (0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]
    return mix(np.array(sums, np.uint64)).tobytes()


def links(n, m, overlap, percent: int):
    return 100 * overlap >= percent * (n + m - overlap)


def _sketches(docs: DataFrame, n: int) -> DataFrame:
    """``doc_id, n_shingles, sig, regs, bits``; the last three are null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                sets = list(shingle_sets(batch.column("text"), n))
                full = [s for s in sets if len(s)]
                rows = iter(registers(full)) if full else iter(())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([set_hash(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary()),
                        pa.array([bitmap(s) if len(s) else None for s in sets], pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "sig", "regs", "bits"],
                )

    return docs.mapInArrow(run, "doc_id bigint, n_shingles bigint, sig binary, regs binary, bits binary")


def band_keys(regs: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each sketch."""
    parts = regs.reshape(len(regs), BANDS, ROWS).astype(np.uint64)
    total = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95), parts.shape[:2]).copy()
    for row in range(ROWS):
        total = mix(total ^ parts[:, :, row]) + np.uint64(row + 1)
    return total


def _sketch_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _bands(nodes: DataFrame) -> DataFrame:
    """``band, key, sig`` for every node and band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = band_keys(_sketch_rows(batch.column("regs")))
            places = np.repeat(np.arange(batch.num_rows), BANDS)
            bands = np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(bands), pa.array(keys.reshape(-1).view(np.int64)), batch.column("sig").take(pa.array(places))], ["band", "key", "sig"])

    return nodes.select("sig", "regs").mapInArrow(run, "band int, key bigint, sig binary")


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` that are candidates by their estimates and bitmaps."""
    for side in "ab":
        own = nodes.select(F.col("sig").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("size", "regs", "bits")])
        pairs = pairs.join(own, side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (np.asarray(batch.column(c)) for c in ("size_a", "size_b"))
            same = (_sketch_rows(batch.column("regs_a")) == _sketch_rows(batch.column("regs_b"))).sum(1)
            keep = estimate(same, n, m) >= least_estimate(n, m, percent)
            bits = zip(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist(), strict=True)
            keep &= [bits_apart(x, y) * (100 + percent) <= (100 - percent) * s for (x, y), s in zip(bits, (n + m).tolist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    close = pairs.where(100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b"))
    return close.mapInArrow(run, "a binary, b binary")


def _confirmed(docs: DataFrame, pairs: DataFrame, nodes: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs whose full sets link."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct().join(nodes.select("sig", "rep"), "sig")
    wanted = stage(wanted.select("sig", F.col("rep").alias("doc_id")))
    few = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    found = docs.join(F.broadcast(wanted) if few else wanted, "doc_id").select("sig", "text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                rows = zip(batch.column("sig").to_pylist(), shingle_sets(batch.column("text"), n), strict=True)
                own = [(sig, s.tobytes()) for sig, s in rows if len(s) and set_hash(s) == sig]
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in own], pa.binary()) for i in (0, 1)], ["sig", "grams"])

    sets = stage(found.mapInArrow(hashed, "sig binary, grams binary").groupBy("sig").agg(F.max("grams").alias("grams")))
    for side in "ab":
        pairs = pairs.join(sets.select(F.col("sig").alias(side), F.col("grams").alias(f"grams_{side}")), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("grams_a").to_pylist(), batch.column("grams_b").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                keep.append(bool(links(len(x), len(y), len(np.intersect1d(x, y, assume_unique=True)), percent)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return stage(pairs.mapInArrow(run, "a binary, b binary"))


def cross_pairs(left: dict, right: dict | None, band: int, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of a block, the rows of the other block (of its own, further down, if there is no other) that are candidates and in
    another class. Blocks are ``regs, size, class, bits``."""
    other = right or left
    for i in range(len(left["size"])):
        start = 0 if right else i + 1
        size, n = other["size"][start:], left["size"][i]
        fit = (other["class"][start:] != left["class"][i]) & (100 * np.minimum(size, n) >= percent * np.maximum(size, n))
        at = np.flatnonzero(fit) + start
        if not len(at):
            continue
        equal = other["regs"][at] == left["regs"][i]
        meets = equal.reshape(len(at), BANDS, ROWS).all(2)
        sizes = other["size"][at]
        keep = (meets.argmax(1) == band) & meets[:, band]
        keep &= estimate(equal.sum(1), np.full(len(at), n), sizes) >= least_estimate(np.full(len(at), n), sizes, percent)
        near = [j for j in at[keep].tolist() if bits_apart(left["bits"][i], other["bits"][j]) * (100 + percent) <= (100 - percent) * (n + other["size"][j])]
        if near:
            yield i, np.array(near)


def _across(members: DataFrame, classes: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Candidates ``a, b`` of different classes that share a band."""
    known = members.join(classes.withColumnRenamed("node", "sig"), "sig", "left").withColumn("class", F.coalesce("component", "sig")).drop("component")
    first = known.where("first").select("band", "key", F.col("class").alias("main")).dropDuplicates(["band", "key"])
    known = known.join(first, ["band", "key"]).withColumn("other", F.col("class") != F.col("main"))
    counts = known.groupBy("band", "key").agg(F.count_if("other").alias("others"), F.count("*").alias("all")).where("others > 0")
    n_main, n_other = F.ceil((F.col("all") - F.col("others")) / BLOCK).cast("int"), F.ceil(F.col("others") / BLOCK).cast("int")
    rows = known.join(counts.select("band", "key", n_main.alias("n_main"), n_other.alias("n_other")), ["band", "key"])
    # Blocks of the main class have the numbers below n_main; a row goes to every pair of blocks that holds its own and one of the others.
    place = F.xxhash64("sig", F.lit(1))
    own = F.when(F.col("other"), F.col("n_main") + F.pmod(place, "n_other")).otherwise(F.pmod(place, "n_main")).cast("int")
    partners = F.sequence(F.when(F.col("other"), 0).otherwise(F.col("n_main")), F.col("n_main") + F.col("n_other") - 1)
    rows = rows.withColumn("own", own).withColumn("partner", F.explode(partners))
    rows = rows.select("band", "key", F.least("own", "partner").alias("i"), F.greatest("own", "partner").alias("j"), "own", "class", "sig")
    group = ["band", "key", "i", "j"]
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.join(nodes.select("sig", "size", "regs", "bits"), "sig").repartition(parts, *group).sortWithinPartitions(*group, "own")

    def pairs(key: tuple, held: list[tuple]) -> tuple[list, list]:
        band, _, i, j = key

        def block(number: int) -> dict:
            own = [r for r in held if r[0] == number]
            regs = np.frombuffer(b"".join(r[4] for r in own), np.uint16).reshape(-1, REGISTERS)
            return {"regs": regs, "size": np.array([r[3] for r in own]), "class": np.array([r[1] for r in own], object), "bits": [r[5] for r in own], "sig": [r[2] for r in own]}

        left, right = block(i), block(j) if j != i else None
        a, b = [], []
        for row, found in cross_pairs(left, right, band, percent):
            for other in found.tolist():
                low, high = sorted((left["sig"][row], (right or left)["sig"][other]))
                a.append(low)
                b.append(high)
        return a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for *own_key, own, cls, sig, size, regs, bits in zip(*columns, strict=True):
                if tuple(own_key) != key:
                    if key:
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in pairs(key, held)], ["a", "b"])
                    key, held = tuple(own_key), []
                held.append((own, cls, sig, size, regs, bits))
        if key:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in pairs(key, held)], ["a", "b"])

    return rows.select(*group, "own", "class", "sig", "size", "regs", "bits").mapInArrow(run, "a binary, b binary")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``; ``kept`` is the document that names its class."""
    docs = docs.select(docs[f"`{id_col}`"].cast("bigint").alias("doc_id"), docs[f"`{text_col}`"].alias("text"))
    sketches = stage(_sketches(docs, n))
    nodes = stage(
        sketches.where("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("size"), F.max("regs").alias("regs"), F.max("bits").alias("bits"))
    )
    bands = _bands(nodes.where("rep is not null")).withColumn("turn", F.xxhash64("sig", "band"))
    shared = bands.groupBy("band", "key").agg(F.min("turn").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
    members = stage(bands.join(shared, ["band", "key"]).select("band", "key", "sig", (F.col("turn") == F.col("least")).alias("first")))

    firsts = members.where("first").select("band", "key", F.col("sig").alias("x"))
    star = members.where("not first").join(firsts, ["band", "key"]).select(F.least("x", "sig").alias("a"), F.greatest("x", "sig").alias("b")).distinct()
    tested = stage(_likely(star, nodes, percent))
    found = _confirmed(docs, tested, nodes, n, percent)
    classes = connected(found)
    more = stage(_across(members, stage(classes), nodes, percent).join(tested, ["a", "b"], "left_anti"))
    if not more.isEmpty():
        classes = connected(found.unionAll(_confirmed(docs, more, nodes, n, percent)))

    named = nodes.select("sig", "rep").join(classes.withColumnRenamed("node", "sig"), "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    ids = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_sig = named.join(ids, "component").select("sig", "component_id")
    out = sketches.select("doc_id", "n_shingles", "sig").join(of_sig, "sig", "left")
    out = out.select("doc_id", "n_shingles", F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
