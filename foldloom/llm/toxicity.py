"""Toxicity scores from a factorization machine over hashed terms.

The machine is ``w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j`` over the terms present in a text, so a pair of terms
has a weight of its own and not only the sum of two. Terms are words in lower case and the first six bytes of longer
words, as buckets of a 22-bit hash; capital letters of ASCII and Latin-1 are lowered. A bucket has parameters if at least ``min_docs`` training rows hold it and its share
of toxic rows is more than ``min_z`` standard deviations from the share among all rows.

It is fitted on the driver on at most ``max_rows`` labelled rows, those with the smallest hash of the id, and sent to the tasks as
arrays of that bounded size. Scoring reads whole texts and shuffles nothing.

Null and empty texts, and texts without known terms, get the score of the bias. Rows with equal ids are scored one by one.
Label rows with a null id, a null label, or no document teach nothing. Without any training row every score is 0.5 and
``predicted`` is 0. Columns beside the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldloom.llm.words import NON_TERM, lowered, slices, spans, utf8, word_hashes
from foldloom.session import bound_batches

BITS = 22
PREFIX = 6


def term_buckets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Distinct buckets of each text, sorted."""
    data, offsets = utf8(texts)
    data = lowered(data)
    accented = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    data[accented] += 0x20
    starts, stops, firsts = spans(data, offsets, NON_TERM)
    cut = np.minimum(stops, starts + PREFIX)
    shift = np.uint64(64 - BITS)
    both = np.empty(2 * len(starts), np.uint32)
    both[0::2] = word_hashes(data, starts, stops) >> shift
    both[1::2] = (word_hashes(data, starts, cut) ^ np.uint64(0x5851F42D4C957F2D)) >> shift
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
        own = np.sort(both[2 * a : 2 * b])
        yield own[np.concatenate(([True], own[1:] != own[:-1]))] if len(own) else own


@dataclass
class FactorizationMachine:
    """``place`` gives the row of a bucket in ``w`` and ``v``, or -1."""

    buckets: np.ndarray
    bias: float
    w: np.ndarray
    v: np.ndarray

    def place(self) -> np.ndarray:
        place = np.full(1 << BITS, -1, np.int32)
        place[self.buckets] = np.arange(len(self.buckets), dtype=np.int32)
        return place

    def scores(self, texts: pa.Array, place: np.ndarray) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        for i, found in enumerate(term_buckets(texts)):
            rows = place[found]
            rows = rows[rows >= 0]
            if len(rows):
                v = self.v[rows]
                total = v.sum(axis=0)
                out[i] += self.w[rows].sum() + 0.5 * (total @ total - (v * v).sum())
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def fit(
    rows: list[np.ndarray], labels: np.ndarray, min_docs: int = 4, min_z: float = 4.0, factors: int = 4,
    epochs: int = 15, rate: float = 0.2, l2: float = 1e-3, seed: int = 7,
) -> FactorizationMachine:
    """Minimise the logistic loss with AdaGrad over small batches."""
    # One pass over the rows, whose buckets are distinct, so that memory does not depend on the number of their terms.
    docs, hits = np.zeros(1 << BITS, np.int32), np.zeros(1 << BITS, np.int32)
    for own, label in zip(rows, labels, strict=True):
        docs[own] += 1
        if label:
            hits[own] += 1
    buckets = np.flatnonzero(docs).astype(np.uint32)
    docs, hits = docs[buckets].astype(np.int64), hits[buckets].astype(np.float64)
    mean = labels.mean() if len(labels) else 0.0
    z = (hits - docs * mean) / np.sqrt(np.maximum(docs * mean * (1 - mean), 1e-9))
    buckets = buckets[(docs >= min_docs) & (np.abs(z) > min_z)]
    rng = np.random.default_rng(seed)
    w, v = np.zeros(len(buckets)), rng.normal(0, 0.01, (len(buckets), factors))
    share = float(np.clip(labels.mean(), 0.01, 0.99)) if len(labels) else 0.5
    bias = float(np.log(share / (1 - share)))
    machine = FactorizationMachine(buckets, bias, w, v)
    if not len(buckets) or labels.min() == labels.max():
        return machine
    place = machine.place()
    known = [p[p >= 0] for p in (place[r] for r in rows)]
    gw, gv, gb = np.full(len(w), 1e-6), np.full(v.shape, 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(known))
        for batch in np.array_split(order, max(1, len(order) // 64)):
            sizes = np.array([len(known[i]) for i in batch])
            index = np.concatenate([known[i] for i in batch])
            doc = np.repeat(np.arange(len(batch)), sizes)
            vi = v[index]
            total, squares = np.zeros((len(batch), factors)), np.zeros(len(batch))
            np.add.at(total, doc, vi)
            np.add.at(squares, doc, (vi * vi).sum(axis=1))
            linear = np.bincount(doc, w[index], len(batch))
            z = machine.bias + linear + 0.5 * ((total * total).sum(axis=1) - squares)
            error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[batch]
            touched, where = np.unique(index, return_inverse=True)
            step_w = np.bincount(where, error[doc], len(touched)) + l2 * w[touched]
            pull = np.zeros((len(touched), factors))
            np.add.at(pull, where, error[doc][:, None] * (total[doc] - vi))
            step_v = pull + l2 * v[touched]
            gw[touched] += step_w**2
            gv[touched] += step_v**2
            gb += float(error.sum()) ** 2
            w[touched] -= rate * step_w / np.sqrt(gw[touched])
            v[touched] -= 0.25 * rate * step_v / np.sqrt(gv[touched])
            machine.bias -= 0.25 * rate * float(error.sum()) / gb**0.5
    return machine


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label",
    max_rows: int = 12_000,
) -> FactorizationMachine:
    """Fit on at most ``max_rows`` label rows, the same ones under any partitioning. Their ids are few enough to
    broadcast, so the texts are found by a scan without a shuffle."""
    bound_batches(docs.sparkSession)
    usable = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label"))
    usable = usable.where(F.col("id").isNotNull() & F.col("label").isin(0.0, 1.0))
    chosen = usable.orderBy(F.xxhash64("id"), "id", "label").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = texts.join(F.broadcast(chosen), "id").select("text", "label")

    def features(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                found = [x.tobytes() for x in term_buckets(batch.column("text"))]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), batch.column("label")], ["terms", "label"])

    # The terms of all rows stay in one Arrow buffer; rows are views of it, in an order that depends on their values alone.
    rows = sample.mapInArrow(features, "terms binary, label double").toArrow().combine_chunks()
    if not rows.num_rows:
        return fit([], np.zeros(0))
    order = np.asarray(pc.sort_indices(rows, [("terms", "ascending"), ("label", "ascending")]))
    column = rows.column("terms").chunk(0).cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] // 4
    values = np.frombuffer(column.buffers()[2] or b"", np.uint32)
    return fit([values[offsets[i] : offsets[i + 1]] for i in order.tolist()], rows.column("label").to_numpy()[order])


def score(docs: DataFrame, machine: FactorizationMachine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score, predicted`` for every row."""
    id_type = docs.schema[id_col].dataType.simpleString()
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        model, place = shared.value, None
        for whole in batches:
            place = model.place() if place is None else place
            for batch in slices(whole, "text"):
                values = model.scores(batch.column("text"), place)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(values), pa.array((values >= 0.5).astype(np.int32))],
                    ["id", "score", "predicted"],
                )

    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, score double, predicted int"
    )
    return found.withColumnRenamed("id", id_col)


def keep_clean(docs: DataFrame, machine: FactorizationMachine, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, that are not predicted to be toxic."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        model, place = shared.value, None
        for whole in batches:
            place = model.place() if place is None else place
            for batch in slices(whole, text_col):
                yield batch.filter(pa.array(model.scores(batch.column(text_col), place) < 0.5))

    return docs.mapInArrow(run, docs.schema)
