"""Alignment of two tokenizers: groups of tokens between shared cuts, and the links of tokens that end together.

A is a byte-level BPE (its ``tokenizers`` JSON, applied by rank through tiktoken), B a sentencepiece model. Both encode a space and the text. A cut is a byte
offset where a token of A and a token of B end. ``shared_cuts`` finds the cuts of texts by divide and conquer: in an interval it bisects for a common
end next to the middle, on one side and the other in turn, and goes on with both halves; an interval without a cut is a leaf, which is one
group. All intervals of one depth, over the texts of a slice of a batch, are searched together.

How often an id pair is linked is counted over the whole corpus by Spark; documents meet the counts again through a join on the
pair, with a broadcast only if the counted pairs are few. A null or empty text, one that is not valid UTF-8, and one whose tokens do not give
its bytes back have no tokens: zeros and an empty ``groups_sha256``. Rows with equal or null ids are rows of their own. An
empty table gives an empty table. Other columns are ignored. A whole text and its tokens have to fit into a task.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldloom.llm.words import slices
from foldloom.storage import stage

# Fixed value: the pattern of byte-level BPE that splits a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE = "▁"
IDS = 1 << 16
SLICE_BYTES = 1 << 20
BROADCAST_ROWS = 1_000_000


def byte_signs() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


def read_files(byte_bpe: str, pieces: str) -> tuple[dict[bytes, int], bytes]:
    """Token bytes and ids of A, and the model of B."""
    with open(byte_bpe, encoding="utf-8") as f:
        model = json.load(f)["model"]
    signs, vocab = byte_signs(), model["vocab"]
    for rank, merge in enumerate(model["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        if vocab[left + right] != 256 + rank:
            raise ValueError("the ids of this vocabulary are not in the order of its merges")
    with open(pieces, "rb") as f:
        return {bytes(signs[c] for c in token): i for token, i in vocab.items()}, f.read()


def shared_cuts(a: np.ndarray, b: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The places of the ends in ``a`` that are in ``b`` too, ascending. Both are ascending and ``b`` ends no earlier than ``a``; ``starts`` and
    ``stops`` are the intervals of places to begin with."""
    cuts, low, high = [np.zeros(0, np.int64)], starts, stops
    while len(low):
        right = (low + high) // 2
        left = right - 1
        lows, highs, at = [], [], np.flatnonzero(low < high)
        while len(at):
            # A miss goes on behind the end of b that it met, so that no end between is looked up.
            for step in (1, -1):
                probe = (right if step > 0 else left)[at]
                open_ = probe < high[at] if step > 0 else probe >= low[at]
                tried, probe = at[open_], probe[open_]
                ends = a[probe]
                met = np.searchsorted(b, ends)
                hit = b[met] == ends
                missed, met = tried[~hit], met[~hit]
                if step > 0:
                    right[missed] = np.searchsorted(a, b[met])
                else:
                    left[missed] = np.where(met > 0, np.searchsorted(a, b[met - 1], "right") - 1, -1)
                cut, found = probe[hit], tried[hit]
                cuts.append(cut)
                # What lies between left and right has no cut and belongs to neither half.
                lows += [low[found], cut + 1 if step > 0 else right[found]]
                highs += [left[found] + 1 if step > 0 else cut, high[found]]
                if len(found):
                    still = np.ones(len(low), bool)
                    still[found] = False
                    at = at[still[at]]
            at = at[(right[at] < high[at]) | (left[at] >= low[at])]
        low, high = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (lows, highs))
    return np.sort(np.concatenate(cuts))


class Aligner:
    """Both tokenizers in a task."""

    def __init__(self, ranks: dict[bytes, int], model: bytes):
        import sentencepiece
        import tiktoken

        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes_a = [b""] * IDS
        for token, i in ranks.items():
            self.bytes_a[i] = token
        self.bytes_b = []
        for i in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode())
        self.sizes = [np.array([len(t) for t in tokens]) for tokens in (self.bytes_a, self.bytes_b)]
        self.signs = [f"{i}{mark}" for i in range(IDS) for mark in ",|;"]

    def tokens(self, texts: list[bytes | None]) -> dict[int, tuple[list[int], list[int]]]:
        """The tokens of the texts that have some, by place."""
        plain = {}
        for place, text in enumerate(texts):
            try:
                plain[place] = text.decode() if text else ""
            except UnicodeDecodeError:
                continue
        plain = {place: text for place, text in plain.items() if text}
        out = {}
        for (place, text), b in zip(plain.items(), self.b.encode(list(plain.values()), num_threads=1), strict=True):
            a, raw = self.a.encode_ordinary(f" {text}"), b" " + texts[place]
            if all(b"".join([own[i] for i in ids]) == raw for own, ids in ((self.bytes_a, a), (self.bytes_b, b))):
                out[place] = a, b
        return out

    def align(self, texts: list[bytes | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """For each text the numbers of tokens of A and B, of groups, and of different linked id pairs; the digests of the groups; the
        pairs of all texts one after another; how often each is linked."""
        numbers, digests = np.zeros((4, len(texts)), np.int64), [""] * len(texts)
        found = self.tokens(texts)
        if not found:
            return numbers, digests, np.zeros(0, np.int64), np.zeros(0, np.int64)
        places = np.array(list(found))
        flat, firsts, ends = [], [], []
        for side in (0, 1):
            sizes = np.array([len(x[side]) for x in found.values()])
            ids = np.fromiter(chain.from_iterable(x[side] for x in found.values()), np.int64, sizes.sum())
            flat.append(ids)
            firsts.append(np.concatenate(([0], np.cumsum(sizes))))
            ends.append(np.cumsum(self.sizes[side][ids]))
            numbers[side, places] = sizes
        cut_a = shared_cuts(ends[0], ends[1], firsts[0][:-1], firsts[0][1:])
        cut_b = np.searchsorted(ends[1], ends[0][cut_a])

        # Tokens in the order of the written groups: those of A, then those of B, group by group.
        is_a, is_b = np.zeros(len(flat[0]), bool), np.zeros(len(flat[1]), bool)
        is_a[cut_a], is_b[cut_b] = True, True
        group_a, group_b = np.cumsum(is_a) - is_a, np.cumsum(is_b) - is_b
        written = np.empty(len(flat[0]) + len(flat[1]), np.int64)
        written[np.arange(len(flat[0])) + np.concatenate(([0], cut_b + 1))[group_a]] = flat[0] * 3 + is_a
        written[np.arange(len(flat[1])) + cut_a[group_b] + 1] = flat[1] * 3 + 2 * is_b
        for i, place in enumerate(places.tolist()):
            part = written[firsts[0][i] + firsts[1][i] : firsts[0][i + 1] + firsts[1][i + 1]].tolist()
            digests[place] = hashlib.sha256("".join([self.signs[x] for x in part])[:-1].encode()).hexdigest()

        owner = np.searchsorted(firsts[0], cut_a, "right") - 1
        numbers[2, places] = np.bincount(owner, minlength=len(places))
        keys, times = np.unique(owner << 32 | flat[0][cut_a] * IDS + flat[1][cut_b], return_counts=True)
        numbers[3, places] = np.bincount(keys >> 32, minlength=len(places))
        return numbers, digests, keys & 0xFFFFFFFF, times.astype(np.int64)


def aligned_documents(docs: DataFrame, byte_bpe: str, pieces: str) -> DataFrame:
    """``row, doc_id, n_a, n_b, n_groups, groups_sha256, links`` for each row of ``row, doc_id, text``."""
    files = docs.sparkSession.sparkContext.broadcast(read_files(byte_bpe, pieces))
    link = pa.struct([("pair", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*files.value)
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                numbers, digests, pairs, times = aligner.align(batch.column("text").to_pylist())
                links = pa.StructArray.from_arrays([pa.array(pairs), pa.array(times)], fields=list(link))
                offsets = pa.array(np.concatenate(([0], np.cumsum(numbers[3]))), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), batch.column("doc_id"), *map(pa.array, numbers[:3]), pa.array(digests), pa.ListArray.from_arrays(offsets, links)],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"],
                )

    return docs.mapInArrow(run, "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, links array<struct<pair:bigint,n:bigint>>")


def link_counts(aligned: DataFrame) -> DataFrame:
    """``pair, count, best``: how many links hold an id pair linked, and whether no pair of its B id has more."""
    counts = aligned.select(F.inline("links")).groupBy("pair").agg(F.sum("n").alias("count"))
    # At most as many rows as A has ids.
    most = F.max("count").over(Window.partitionBy(F.col("pair") % IDS))
    return counts.withColumn("best", F.col("count") == most)


def alignment(docs: DataFrame, byte_bpe: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``docs``."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs[f"`{id_col}`"].cast("bigint").alias("doc_id"), docs[f"`{text_col}`"].cast("binary").alias("text"))
    aligned = stage(aligned_documents(rows, byte_bpe, pieces))
    counts = stage(link_counts(aligned))
    few = counts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    used = aligned.select("row", F.inline("links")).join(F.broadcast(counts) if few else counts, "pair")
    sums = used.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum"))
    out = aligned.drop("links").join(sums, "row", "left")
    zero = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("n_best", "count_sum")]
    # Each cut ends one token of A and one of B.
    return out.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), *zero, "groups_sha256")
