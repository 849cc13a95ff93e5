"""Words, hashes and shingles of whole texts, as NumPy arrays over Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes between words: space and the ASCII controls from tab to carriage return.
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# Bytes between terms: all of ASCII but letters and digits. Bytes of longer UTF-8 sequences belong to terms.
NON_TERM = np.ones(256, bool)
NON_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

SLICE_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C55
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))


@lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    both = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        both.append(np.cumprod(steps, dtype=np.uint64))
    return both[0], both[1]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text each; a longer text is a part of its own. The column holds the texts or their sizes."""
    texts = batch.column(column)
    sizes = texts if pa.types.is_integer(texts.type) else pc.binary_length(texts)
    ends = np.cumsum(np.asarray(pc.fill_null(sizes, 0)))
    start = 0
    while start < batch.num_rows:
        floor = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, floor + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins and the last ends. Null counts as empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the first word of each text (one entry more than texts)."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~separators[data]
    first, last = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True
    last[offsets[1:]] = True
    begins = inside[1:-1] & (~inside[:-2] | first[:-1])
    ends = inside[1:-1] & (~inside[2:] | last[1:])
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, stops, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64-bit hashes of words, from prefix sums of a polynomial over their bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = max(SLICE_BYTES, 1 << (len(data) + 1).bit_length())
    up, down = _powers(size)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
    return mix((sums[stops] - sums[starts]) * down[starts])


def lowered(data: np.ndarray) -> np.ndarray:
    return LOWER[data]


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every run of ``n`` values; runs that cross texts are for the caller to leave out."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    factor = 1
    for i in range(n):
        factor = factor * 0xD6E8FEB86659FD93 & _MASK
        total += words[i : len(words) - n + 1 + i] * np.uint64(factor | 1)
    return mix(total)


def range_hashes(words: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hashes of runs of words of any lengths, from prefix sums of a polynomial over their hashes."""
    up, down = _powers(max(SLICE_BYTES, 1 << (len(words) + 1).bit_length()))
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return mix((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64))


def shingle_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """For each text its distinct shingles of ``n`` words, A-Z lower-cased, as sorted 64-bit hashes.

    A text with fewer words gives its whole sequence as one shingle, a text without words gives none.
    """
    data, offsets = utf8(texts)
    data = lowered(data)
    starts, stops, firsts = spans(data, offsets, WHITE)
    words = word_hashes(data, starts, stops)
    grams = gram_hashes(words, n)
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
        if b - a >= n:
            own = np.sort(grams[a : b - n + 1])
            yield own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif b > a:
            yield mix(gram_hashes(words[a:b], b - a) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)
