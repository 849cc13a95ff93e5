"""Removal of every word covered by a window of words that starts anywhere else too, by FM-indexes over shards of the corpus.

Routing: each window of ``window`` words selects the smallest hash among its runs of ``ANCHOR`` words, the first one in a tie. Equal windows select
the same anchor, so a window can only repeat if its anchor is selected at two places. Windows in a row with one anchor form a segment, and the segments of
repeated anchors are dealt to shards by anchor. Equal segments count once, with a weight, within each task already. The windows of an anchor
that is selected more than ``HOT`` times are dealt out one by one by their own hash, so that no shard has to hold all places of
a line or passage that is found everywhere.

Matching: a shard builds an FM-index (BWT in a wavelet matrix) of its segments and streams the windows of the segments through a backward
search, all windows in step. A window is repeated when its occurrences weigh two or more. The repeated windows of each document are brought together as
intervals, and the words they cover are taken out. Windows are judged on the input.

A null or empty text has no words and keeps the empty string; a text with fewer words than a window keeps all. Repeated rows
repeat each other's windows. Rows are told apart by id and text, so null and equal ids are fine. Columns beside id and text are ignored by ``mark``.
Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldloom.llm.fm_index import FMIndex
from foldloom.llm.words import WHITE, gram_hashes, range_hashes, slices, spans, utf8, word_hashes
from foldloom.session import bound_batches
from foldloom.storage import stage

ANCHOR = 12
HOT = 2000
SHARD_WORDS = 1 << 17
HELD_WORDS = 1 << 21
PLACE_BITS = 26
LONG = pa.int64()


def runs(words: np.ndarray, firsts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows in a row that select the same anchor: first window, number of windows, anchor hash, text; places count
    words of all texts."""
    grams = gram_hashes(words, ANCHOR)
    n = len(words) - window + 1
    empty = np.zeros(0, np.int64)
    if n <= 0:
        return empty, empty, empty, empty
    keys = (grams >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(grams), dtype=np.uint64)
    width, span = window - ANCHOR + 1, 1
    while 2 * span <= width:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    rest = width - span
    keys = np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys
    chosen = (keys & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    text = np.searchsorted(firsts, np.arange(n), side="right") - 1
    whole = np.arange(n) + window <= firsts[text + 1]
    places = np.flatnonzero(whole)
    if not len(places):
        return empty, empty, empty, empty
    anchors, text = chosen[places], text[places]
    new = np.concatenate(([True], (anchors[1:] != anchors[:-1]) | (text[1:] != text[:-1])))
    at = np.flatnonzero(new)
    return places[at], np.diff(np.append(at, len(places))), grams[anchors[at]].view(np.int64), text[at]


def _anchors(docs: DataFrame, window: int) -> DataFrame:
    """``anchor, row, run`` with the first window and the number of windows of a run in one number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                data, offsets = utf8(batch.column("text"))
                starts, stops, firsts = spans(data, offsets, WHITE)
                place, count, anchor, text = runs(word_hashes(data, starts, stops), firsts, window)
                rows = batch.column("row").take(pa.array(text))
                packed = pa.array((place - firsts[text]) * 64 + count, LONG)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), rows, packed], ["anchor", "row", "run"])

    return docs.select("row", "text").mapInArrow(run, "anchor bigint, row bigint, run bigint")


def _packed(docs: DataFrame) -> DataFrame:
    """Rows with their text compressed, for shuffles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = [x.encode() for x in batch.column("text").fill_null("").to_pylist()]
                packed = [codec.compress(x, asbytes=True) for x in texts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), pa.array([len(x) for x in texts], LONG), pa.array(packed, pa.binary())], ["row", "size", "packed"]
                )

    return docs.select("row", "text").mapInArrow(run, "row bigint, size bigint, packed binary")


def flat(lists: pa.Array, fields: tuple[str, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where the structs of each list begin and end, and their fields one after another; null lists are empty."""
    values = lists.flatten()
    sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
    return np.concatenate(([0], np.cumsum(sizes))), [values.field(f).to_numpy(zero_copy_only=False) for f in fields]


def _segments(rows: DataFrame, window: int) -> DataFrame:
    """From ``packed`` texts with the runs of repeated anchors: one row ``segment, row, place`` per segment, and once per task and
    segment ``segment, shard, words, windows, weight``."""
    names = ["segment", "row", "place", "shard", "words", "windows", "weight"]
    kinds = [LONG, LONG, LONG, LONG, pa.binary(), LONG, LONG]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        held: dict[int, list] = {}
        size = 0

        def contents() -> Iterator[pa.RecordBatch]:
            rest = iter(held.items())
            while some := [(k, None, None, *v) for k, v in islice(rest, 4096)]:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), kinds, strict=True)], names)

        for batch in batches:
            found: list[tuple[np.ndarray, int, np.ndarray]] = []
            bounds, (run_, anchor, hot) = flat(batch.column("hits"), ("run", "anchor", "hot"))
            columns = (batch.column(c).to_pylist() for c in ("row", "size", "packed"))
            for i, (row, length, packed) in enumerate(zip(*columns, strict=True)):
                data = np.frombuffer(codec.decompress(packed, length), np.uint8)
                starts, stops, _ = spans(data, np.array([0, len(data)]), WHITE)
                words = word_hashes(data, starts, stops)
                # Repeated rows share a key, and each of their hits is there once for every one of them.
                runs_, at = np.unique(run_[bounds[i] : bounds[i + 1]], return_index=True)
                shards, alone = anchor[bounds[i] : bounds[i + 1]][at], hot[bounds[i] : bounds[i + 1]][at].astype(bool)
                place, count = runs_ >> 6, runs_ & 63
                copies = np.where(alone, count, 1)
                inner = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
                place, count = np.repeat(place, copies) + inner, np.repeat(np.where(alone, 1, count), copies)
                ends = place + count + window - 1
                segment = range_hashes(words, place, ends).view(np.int64)
                shard = np.where(np.repeat(alone, copies), segment, np.repeat(shards, copies))
                found.append((segment, row, place))
                for key, own, first, end, n in zip(segment.tolist(), shard.tolist(), place.tolist(), ends.tolist(), count.tolist(), strict=True):
                    old = held.get(key)
                    if old is not None:
                        old[3] += 1
                    else:
                        held[key] = [own, words[first:end].tobytes(), n, 1]
                        size += end - first
                if size > HELD_WORDS:  # 16 MB of words; a segment may then be given more than once
                    yield from contents()
                    held, size = {}, 0
            if found:
                segment = np.concatenate([f[0] for f in found])
                row = np.repeat(np.array([f[1] for f in found], np.int64), [len(f[0]) for f in found])
                place = np.concatenate([f[2] for f in found])
                nulls = [pa.nulls(len(segment), t) for t in kinds[3:]]
                yield pa.RecordBatch.from_arrays([pa.array(segment), pa.array(row), pa.array(place, LONG), *nulls], names)
        yield from contents()

    return rows.mapInArrow(run, "segment bigint, row bigint, place bigint, shard bigint, words binary, windows bigint, weight bigint")


def _repeated(contents: DataFrame, window: int) -> DataFrame:
    """``segment, mask``: the repeated windows of each segment as bits, found by the FM-index of its shard."""
    n = int(contents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = contents.repartition(n, "shard").sortWithinPartitions("shard", "segment")

    def search(ids: list[int], pieces: list[np.ndarray], windows: list[int], weights: list[int]) -> pa.RecordBatch:
        masks = np.zeros(len(ids), np.int64)
        if ids:
            index = FMIndex(pieces, np.array(weights))
            owner = np.repeat(np.arange(len(ids)), windows)
            inner = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
            twice = index.occurrences(index.starts[owner] + inner, window) >= 2
            np.bitwise_or.at(masks, owner[twice], np.int64(1) << inner[twice])
        keep = np.flatnonzero(masks)
        return pa.RecordBatch.from_arrays([pa.array(np.array(ids, np.int64)[keep]), pa.array(masks[keep])], ["segment", "mask"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, pieces, windows, weights, total, before = [], [], [], [], 0, None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("shard", "segment", "words", "windows", "weight"))
            for shard, segment, words, count, weight in zip(*columns, strict=True):
                if shard != before and total > SHARD_WORDS:
                    yield search(ids, pieces, windows, weights)
                    ids, pieces, windows, weights, total = [], [], [], [], 0
                before = shard
                if ids and ids[-1] == segment:
                    weights[-1] += weight
                    continue
                own = np.frombuffer(words, np.uint64)
                ids.append(segment)
                pieces.append(own)
                windows.append(count)
                weights.append(weight)
                total += len(own)
        yield search(ids, pieces, windows, weights)

    return dealt.mapInArrow(run, "segment bigint, mask bigint")


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` as ``row, others, text``, with a key and all other columns in one, so that no name can clash; and ``row, marks``
    with the repeated windows of those that have any: ``marks`` holds a ``place`` and a ``mask`` of the windows from there on."""
    bound_batches(docs.sparkSession)
    others = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_col))
    keyed = docs.select(F.xxhash64(F.lit(3), id_col, text_col).alias("row"), others.alias("others"), F.col(text_col).alias("text"))
    texts = keyed.select("row", "text")
    anchors = _anchors(texts, window)
    counts = anchors.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    repeated = anchors.join(counts, "anchor").select("row", F.struct("anchor", "run", (F.col("n") > HOT).alias("hot")).alias("hit"))
    hits = stage(repeated.groupBy("row").agg(F.collect_list("hit").alias("hits")))
    found = stage(_segments(_packed(texts).join(hits, "row"), window))
    masks = _repeated(found.where("shard is not null").select("shard", "segment", "words", "windows", "weight"), window)
    places = found.where("shard is null").select("segment", "row", "place").distinct().join(masks, "segment")
    return keyed, places.groupBy("row").agg(F.collect_list(F.struct("place", "mask")).alias("marks"))


def covered(n_words: int, place: np.ndarray, mask: np.ndarray, window: int) -> np.ndarray:
    """Which words lie in a repeated window; ``mask`` has a bit for each window from ``place`` on."""
    which, later = np.nonzero((mask[:, None] >> np.arange(window)) & 1)
    starts = place[which] + later
    edges = np.bincount(starts, minlength=n_words + 1) - np.bincount(starts + window, minlength=n_words + 1)
    return np.cumsum(edges[:n_words]) > 0


def _joined(keyed: DataFrame, marks: DataFrame) -> DataFrame:
    """``row, others, size, packed, marks``: rows beside their marks. Texts are compressed for the shuffle."""
    marks = stage(marks)

    def pack(batches):
        codec = pa.Codec("zstd")
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = [None if x is None else x.encode() for x in batch.column("text").to_pylist()]
                packed = [None if x is None else codec.compress(x, asbytes=True) for x in texts]
                arrays = [batch.column("row"), batch.column("others"), pa.array([len(x or b"") for x in texts], LONG), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["row", "others", "size", "packed"])

    others = keyed.schema["others"].dataType.simpleString()
    return keyed.mapInArrow(pack, f"row bigint, others {others}, size bigint, packed binary").join(marks, "row", "left")


def _kept(batch: pa.RecordBatch, window: int) -> Iterator[tuple[int, int, str | None]]:
    """Number of words, number of removed words, and the kept words joined by one space (None for a null text)."""
    codec = pa.Codec("zstd")
    bounds, (place, mask) = flat(batch.column("marks"), ("place", "mask"))
    for i, (size, packed) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("size", "packed")), strict=True)):
        if packed is None:
            yield 0, 0, None
            continue
        words = codec.decompress(packed, size, asbytes=True).split()  # at the six bytes of white space
        removed = 0
        if bounds[i + 1] > bounds[i]:
            gone = covered(len(words), place[bounds[i] : bounds[i + 1]], mask[bounds[i] : bounds[i + 1]], window)
            removed = int(gone.sum())
            words_kept = compress(words, (~gone).tolist())
        else:
            words_kept = words
        yield len(words), removed, b" ".join(words_kept).decode()


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row."""
    keyed, marks = mark(docs.select(id_col, text_col), id_col, text_col, window)
    rows = _joined(keyed, marks)
    others = keyed.schema["others"].dataType.simpleString()

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "size"):
                found = [(n, removed, hashlib.sha256((text or "").encode()).hexdigest()) for n, removed, text in _kept(batch, window)]
                arrays = [batch.column("others"), *(pa.array([f[i] for f in found], t) for i, t in enumerate((LONG, LONG, pa.string())))]
                yield pa.RecordBatch.from_arrays(arrays, ["others", "n_words", "n_removed", "kept_sha256"])

    counted = rows.mapInArrow(run, f"others {others}, n_words bigint, n_removed bigint, kept_sha256 string")
    return counted.select("others.*", "n_words", "n_removed", "kept_sha256")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """``docs`` with the repeated words taken out of the texts that have any; other texts stay as they are."""
    keyed, marks = mark(docs, id_col, text_col, window)
    rows = _joined(keyed, marks)
    others = keyed.schema["others"].dataType.simpleString()

    def run(batches):
        codec = pa.Codec("zstd")
        for whole in batches:
            for batch in slices(whole, "size"):
                texts = []
                columns = (batch.column(c).to_pylist() for c in ("size", "packed"))
                for (_, removed, text), size, packed in zip(_kept(batch, window), *columns, strict=True):
                    texts.append(text if removed or packed is None else codec.decompress(packed, size, asbytes=True).decode())
                yield pa.RecordBatch.from_arrays([batch.column("others"), pa.array(texts, pa.string())], ["others", "text"])

    cleaned = rows.mapInArrow(run, f"others {others}, text string")
    return cleaned.select(*(F.col("text").alias(c) if c == text_col else F.col(f"others.`{c}`") for c in docs.columns))
