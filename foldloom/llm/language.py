"""Language identification by prediction by partial matching over bytes.

Each language has a context tree of order 0 to 3: how often each byte followed each context of up to three bytes in its training
texts. A byte that a context has not seen costs an escape to the next shorter context (method C: escape ``q / (n + q)``,
byte ``c / (n + q)`` for a context seen ``n`` times with ``q`` different bytes, without exclusions), and below order 0 all 256 bytes are
equally likely. The statistics are frozen before scoring, so the code length of a text under a language is a sum over its bytes.
The language with the shortest code wins; ties go to the first in alphabetical order.

Training reads the rows of at most ``per_language`` ids of each language, those with the smallest hash; more than
``MAX_LANGUAGES`` languages are refused. The contexts that these rows hold are the only things that pass through the driver. Scoring reads whole texts and shuffles nothing.

A null text, or one without a letter, is ``und`` with score 0. Rows with a null language teach nothing; with no training row at all every
text is ``und``. Columns beside id, text and language are ignored, and rows with equal ids are scored one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldloom.llm.words import slices, utf8

ORDER = 3
PAD = 0x0A
MAX_LANGUAGES = 1000


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each byte with the three before it, as one number; texts are preceded by line feeds."""
    starts = offsets[:-1] + ORDER * np.arange(1, len(offsets))
    padded = np.full(len(data) + ORDER * (len(offsets) - 1), PAD, np.uint32)
    keep = np.ones(len(padded), bool)
    for back in range(1, ORDER + 1):
        keep[starts - back] = False
    padded[keep] = data
    out = padded.copy()
    for back in range(1, ORDER + 1):
        out[back:] |= padded[:-back] << np.uint32(8 * back)
    return out[keep]


@dataclass
class Level:
    """Costs in bits by language of keys of one order, in an open hash table with up to ``probes`` steps."""

    keys: np.ndarray
    costs: np.ndarray

    def __post_init__(self):
        self.bits = max(8, int(2 * len(self.keys) + 1).bit_length() + 1)
        size = 1 << self.bits
        self.slots = np.full(size, -1, np.int32)
        left, place, self.probes = np.arange(len(self.keys)), self._slot(self.keys), 0
        while len(left):
            free = self.slots[place] < 0
            self.slots[place[free]] = left[free]
            stay = self.slots[place] != left
            left, place = left[stay], (place[stay] + 1) & (size - 1)
            self.probes += 1

    def _slot(self, keys):
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of every key, or -1."""
        found = np.full(len(keys), -1, np.int32)
        if not len(self.keys):
            return found
        place, open_ = self._slot(keys), None
        for step in range(self.probes):
            if open_ is None:
                row = self.slots[place]
                hit = (row >= 0) & (self.keys[row] == keys)
                found[hit] = row[hit]
                open_ = np.flatnonzero((row >= 0) & ~hit)
            else:
                row = self.slots[(place[open_] + step) & (len(self.slots) - 1)]
                hit = (row >= 0) & (self.keys[row] == keys[open_])
                found[open_[hit]] = row[hit]
                open_ = open_[(row >= 0) & ~hit]
            if not len(open_):
                break
        return found


@dataclass
class Model:
    """``symbols[o]``: cost of the last byte of ``o + 1`` bytes where some language has seen them;
    ``escapes[o]``: cost of leaving a context of ``o`` bytes."""

    languages: list[str]
    symbols: list[Level]
    escapes: list[Level]

    def code_lengths(self, keys: np.ndarray) -> np.ndarray:
        """Bits of every byte under every language."""
        bits = np.zeros((len(keys), len(self.languages)), np.float32)
        todo = np.arange(len(keys))
        for order in range(ORDER, -1, -1):
            mask = np.uint32((1 << 8 * (order + 1)) - 1)
            own = keys[todo] & mask
            rows = self.symbols[order].find(own)
            seen = rows >= 0
            bits[todo[seen]] += self.symbols[order].costs[rows[seen]]
            todo, own = todo[~seen], own[~seen]
            if not len(todo):
                break
            rows = self.escapes[order].find(own >> np.uint32(8))
            bits[todo[rows >= 0]] += self.escapes[order].costs[rows[rows >= 0]]
        bits[todo] += 8
        return bits


def build(languages: list[str], counts: list[tuple[np.ndarray, np.ndarray]]) -> Model:
    """From the counts of four-byte keys of each language."""
    symbols, escapes = [], []
    below = None
    for order in range(ORDER + 1):
        mask = np.uint32((1 << 8 * (order + 1)) - 1)
        own = []
        for keys, n in counts:
            cut, where = np.unique(keys & mask, return_inverse=True)
            own.append((cut, np.bincount(where, n, len(cut))))
        union = np.unique(np.concatenate([k for k, _ in own]))
        contexts, place = np.unique(union >> np.uint32(8), return_inverse=True)
        cost, leave = np.zeros((len(union), len(own))), np.zeros((len(contexts), len(own)))
        if below is None:
            shorter = np.full((len(union), len(own)), 8.0)
        else:  # the same last byte after a context shorter by one has been seen too
            shorter = below[1][np.searchsorted(below[0], union & (mask >> np.uint32(8)))]
        for j, (keys, n) in enumerate(own):
            count = np.zeros(len(union))
            count[np.searchsorted(union, keys)] = n
            total = np.bincount(place, count, len(contexts))
            kinds = np.bincount(place, count > 0, len(contexts))
            seen = total > 0
            leave[seen, j] = np.log2((total + kinds)[seen] / kinds[seen])
            cost[:, j] = leave[place, j] + shorter[:, j]
            hit = count > 0
            cost[hit, j] = np.log2((total + kinds)[place][hit] / count[hit])
        symbols.append(Level(union.astype(np.uint32), cost.astype(np.float32)))
        escapes.append(Level(contexts.astype(np.uint32), leave.astype(np.float32)))
        below = (union, cost)
    return Model(languages, symbols, escapes)


def has_letter(texts: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    ascii_letter = ((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A)
    counts = np.concatenate(([0], np.cumsum(ascii_letter)))
    found = counts[offsets[1:]] > counts[offsets[:-1]]
    for i in np.flatnonzero(~found):
        found[i] = any(c.isalpha() for c in texts[i].as_py() or "")
    return found


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 400
) -> Model:
    """Fit on at most ``per_language`` rows of each language, the same ones under any partitioning."""
    rows = docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull())
    rows = rows.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    n_languages = rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).count()
    if n_languages > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not n_languages:
        return Model([], [], [])
    # Every task sends the first rows of each language only, so one with most of the rows costs no more than another.
    first = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id"))
    chosen = rows.select("id", "lang").withColumn("_first", first).where(F.col("_first") <= per_language).drop("_first")
    sample = rows.join(F.broadcast(chosen), ["id", "lang"]).select("lang", "text")

    def count(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                langs = np.array(batch.column("lang").to_pylist(), object)
                for lang in sorted(set(langs)):
                    texts = batch.column("text").take(pa.array(np.flatnonzero(langs == lang)))
                    keys, n = np.unique(grams(*utf8(texts)), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(n)], ["lang", "key", "n"]
                    )

    counted = sample.mapInArrow(count, "lang string, key bigint, n bigint").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    found = counted.toArrow()
    lang = np.array(found.column("lang").to_pylist(), object)
    key, n = found.column("key").to_numpy().astype(np.uint32), found.column("n").to_numpy()
    languages = sorted(set(lang))
    return build(languages, [(key[lang == x], n[lang == x]) for x in languages]) if languages else Model([], [], [])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, lang_pred, score`` for every row. The score is the posterior of the winner, with the code lengths taken per
    byte and weighed as 20 bytes of text, so that it says how clear the choice is and not how long the text is."""
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, "und"], object)
        for whole in batches:
            for batch in slices(whole, "text", 1 << 19):
                texts = batch.column("text")
                data, offsets = utf8(texts)
                usable = has_letter(texts, data, offsets) if model.languages else np.zeros(len(texts), bool)
                best, score = np.full(len(texts), len(names) - 1), np.zeros(len(texts))
                if usable.any():
                    bits = model.code_lengths(grams(data, offsets))
                    sums = np.zeros((len(texts), len(model.languages)))
                    full = np.flatnonzero(np.diff(offsets) > 0)
                    sums[full] = np.add.reduceat(bits, offsets[:-1][full], axis=0, dtype=np.float64)
                    order = sums.argmin(axis=1)
                    mean = sums / np.maximum(np.diff(offsets), 1)[:, None]
                    odds = np.exp2(-20 * (mean - mean.min(axis=1, keepdims=True))).sum(axis=1)
                    best[usable], score[usable] = order[usable], 1 / odds[usable]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(names[best].tolist(), pa.string()), pa.array(score)], ["id", "lang_pred", "score"]
                )

    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, lang_pred string, score double"
    )
    return found.withColumnRenamed("id", id_col)
