"""Quality by hierarchical empirical Bayes: the evidence of a document classifier is combined with what is known of its host and path.

1. A logistic regression over surface features of the whole text (lengths, shares of characters, repeated words and lines) is fitted
   on at most ``max_rows`` labelled rows, those with the smallest hash of the id, on the driver.
2. Every document counts for its path and host: a labelled one with its label, any other with the classifier's probability. Sums per path and host are grouped
   aggregations with partial sums, so a host with a third of the rows costs one row per task.
3. Posteriors shrink: a host's mean towards the mean of all documents, a path's mean towards its host's, each by a prior worth as many
   documents as the spread of the means between groups suggests (method of moments). The document itself is left out of its groups.
4. The score is the logit of the path's posterior plus the classifier's log-likelihood ratio, as a probability; ``keep`` is a score of at least 0.5.

Null hosts and paths are groups of their own. Null and empty texts are scored by their features, all zero. Labels that are null or name no document teach
nothing; without usable labels of both kinds the classifier gives 0.5. Repeated rows count one by one. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldloom.llm.words import NON_TERM, WHITE, slices, spans, utf8, word_hashes
from foldloom.storage import stage

N_FEATURES = 11
UPPER = np.zeros(256, bool)
UPPER[0x41:0x5B] = True
DIGIT = np.zeros(256, bool)
DIGIT[0x30:0x3A] = True
LINE_FEED = np.zeros(256, bool)
LINE_FEED[0x0A] = True


def features(texts: pa.Array) -> np.ndarray:
    """A row of surface features for every text."""
    data, offsets = utf8(texts)
    starts, stops, firsts = spans(data, offsets, WHITE)
    words = word_hashes(data, starts, stops)
    line_starts, line_stops, line_firsts = spans(data, offsets, LINE_FEED)
    lines = word_hashes(data, line_starts, line_stops)
    sums = [np.concatenate(([0], np.cumsum(kind[data]))) for kind in (UPPER, DIGIT, NON_TERM & ~WHITE)]
    out = np.zeros((len(texts), N_FEATURES))
    for i in range(len(texts)):
        a, b = offsets[i], offsets[i + 1]
        own, rows = words[firsts[i] : firsts[i + 1]], lines[line_firsts[i] : line_firsts[i + 1]]
        if not len(own):
            continue
        upper, digit, mark = ((s[b] - s[a]) / (b - a) for s in sums)
        _, times = np.unique(own, return_counts=True)
        repeats = (own[1:] == own[:-1]).mean() if len(own) > 1 else 0.0
        out[i] = (
            1, np.log1p(len(own)), (b - a) / len(own) / 10, upper, digit, mark, 1 - len(times) / len(own), times.max() / len(own), repeats,
            1 - len(np.unique(rows)) / max(len(rows), 1), np.log1p(len(rows)) - np.log1p(len(own)),
        )
    return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 25, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps."""
    weights = np.zeros(N_FEATURES)
    if not len(y) or y.min() == y.max():
        return weights
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - y) + ridge * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(N_FEATURES)
        weights -= np.linalg.solve(curve, gradient)
    return weights


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label", max_rows: int = 12_000) -> np.ndarray:
    usable = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label"))
    usable = usable.where(F.col("id").isNotNull() & F.col("label").isin(0.0, 1.0))
    chosen = usable.orderBy(F.xxhash64("id"), "id", "label").limit(max_rows)
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").select("text", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                rows = [r.tobytes() for r in features(batch.column("text"))]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), batch.column("label")], ["x", "label"])

    found = sample.mapInArrow(run, "x binary, label double").toArrow()
    rows = sorted(zip(found.column("x").to_pylist(), found.column("label").to_pylist(), strict=True))
    x = np.frombuffer(b"".join(r[0] for r in rows), np.float64).reshape(-1, N_FEATURES)
    return fit(x, np.array([r[1] for r in rows]))


def probabilities(docs: DataFrame, weights: np.ndarray, text_col: str, others: list[str]) -> DataFrame:
    """``others`` and the classifier's probability ``p`` for every row."""
    rows = docs.select(*others, F.col(text_col).alias("text_"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text_"):
                p = 1 / (1 + np.exp(-np.clip(features(batch.column("text_")) @ weights, -30, 30)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p)], [*others, "p"])

    return rows.mapInArrow(run, f"{kinds}, p double")


def logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def prior_size(groups: DataFrame) -> float:
    """How many documents a prior is worth, from ``n, s`` (documents and summed evidence) of groups."""
    row = groups.agg(F.count("*"), F.sum("n"), F.sum("s"), F.sum(F.col("s") * F.col("s") / F.col("n")), F.sum(F.col("n") * F.col("n"))).first()
    count, n, s, between, squares = row
    if not count or count < 2 or n <= count:
        return 10.0
    mean = s / n
    within = mean * (1 - mean)
    spread = (between - s * s / n - (count - 1) * within) / max(n - squares / n, 1e-9)
    return float(np.clip(within / spread - 1, 1.0, 1e4)) if spread > 0 else 1e4


def scores(docs: DataFrame, labels: DataFrame, host: str = "host", path: str = "path", id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "label") -> DataFrame:
    """``doc_id, p, host_posterior, path_posterior, score, keep`` for every row of ``docs``."""
    weights = train(docs, labels, id_col, text_col, label_col)
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(id_col).agg(F.min(label_col).cast("double").alias("label_"))
    keyed = docs.withColumn("host_", F.to_json(F.struct(host))).withColumn("path_", F.to_json(F.struct(host, path)))
    rows = probabilities(keyed, weights, text_col, [id_col, "host_", "path_"])
    rows = stage(rows.join(known, id_col, "left").withColumn("e", F.coalesce("label_", "p")).drop("label_"))
    paths = stage(rows.groupBy("host_", "path_").agg(F.count("*").alias("n"), F.sum("e").alias("s")))
    hosts = stage(paths.groupBy("host_").agg(F.sum("n").alias("n"), F.sum("s").alias("s")))
    strong, own = prior_size(hosts), prior_size(paths)
    total = hosts.agg(F.sum("s"), F.sum("n")).first()
    base = total[0] / total[1] if total[1] else 0.5
    joined = rows.join(paths.withColumnsRenamed({"n": "path_n", "s": "path_s"}).drop("host_"), "path_", "left")
    joined = joined.join(hosts.withColumnsRenamed({"n": "host_n", "s": "host_s"}), "host_", "left")
    host_post = (F.col("host_s") - F.col("e") + strong * base) / (F.col("host_n") - 1 + strong)
    path_post = (F.col("path_s") - F.col("e") + own * F.col("host_posterior")) / (F.col("path_n") - 1 + own)
    judged = joined.withColumn("host_posterior", host_post).withColumn("path_posterior", path_post)
    z = logit(F.col("path_posterior")) + logit(F.col("p")) - logit(F.lit(float(base)))
    judged = judged.withColumn("score", 1 / (1 + F.exp(-z)))
    return judged.select(id_col, "p", "host_posterior", "path_posterior", "score", (F.col("score") >= 0.5).alias("keep"))
