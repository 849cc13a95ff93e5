"""An FM-index over word numbers: suffix array by doubling, BWT in a wavelet matrix with packed bits, backward search."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Places of the suffixes in order; the text ends with its only smallest symbol."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    rank = rank.astype(np.int64)
    step = 1
    while True:
        key = rank * (n + 1)
        key[:-step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        step *= 2


class WaveletMatrix:
    """Rank of symbols by one bit vector per bit of a symbol, 64 bits a word with counts before each word."""

    def __init__(self, values: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.words, self.before, self.zeros = [], [], []
        current = values.astype(np.int64)
        for level in range(self.levels - 1, -1, -1):
            bits = (current >> level) & 1
            padded = np.zeros(((len(bits) >> 6) + 1) * 64, np.uint8)
            padded[: len(bits)] = bits
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            self.words.append(words)
            self.before.append(np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1])))
            self.zeros.append(len(bits) - int(bits.sum()))
            current = np.concatenate((current[bits == 0], current[bits == 1]))
        firsts = np.zeros(sigma, np.int64)
        own, at = np.unique(current, return_index=True)
        firsts[own] = at
        self.firsts = firsts

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol stands before the place."""
        for depth in range(self.levels):
            block = places >> 6
            mask = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.before[depth][block] + np.bitwise_count(self.words[depth][block] & mask)
            bit = (symbols >> (self.levels - 1 - depth)) & 1
            places = np.where(bit == 1, self.zeros[depth] + ones, places - ones)
        return places - self.firsts[symbols]


class FMIndex:
    """Over segments of word hashes, each with a weight: how often the segment itself occurs in the corpus."""

    def __init__(self, segments: list[np.ndarray], weights: np.ndarray):
        sizes = np.array([len(s) for s in segments])
        _, numbers = np.unique(np.concatenate(segments), return_inverse=True)
        ends = np.cumsum(sizes + 1)
        text = np.full(ends[-1] + 1, 1, np.int64)
        inside = np.ones(len(text), bool)
        inside[ends - 1] = False
        inside[-1] = False
        text[inside] = numbers + 2
        text[-1] = 0
        self.text = text
        self.starts = ends - sizes - 1
        order = suffix_array(text)
        sigma = int(text.max()) + 1
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma))))
        self.bwt = WaveletMatrix(text[order - 1], sigma)
        owner = np.minimum(np.searchsorted(ends, order, side="right"), len(segments) - 1)
        self.weight = np.concatenate(([0], np.cumsum(np.asarray(weights, np.int64)[owner])))

    def occurrences(self, begins: np.ndarray, length: int) -> np.ndarray:
        """The weight of all occurrences of the patterns ``text[b : b + length]``, by backward search of all of them together.

        A pattern whose interval has come down to one row occurs only where it was taken from, so its search ends there.
        """
        last = self.text[begins + length - 1]
        low, high = self.before[last], self.before[last + 1]
        active = np.arange(len(begins))
        for back in range(length - 2, -1, -1):
            active = active[high[active] - low[active] > 1]
            if not len(active):
                break
            symbols = self.text[begins[active] + back]
            base = self.before[symbols]
            both = self.bwt.rank(np.concatenate((symbols, symbols)), np.concatenate((low[active], high[active])))
            low[active], high[active] = base + both[: len(active)], base + both[len(active) :]
        return self.weight[high] - self.weight[low]
