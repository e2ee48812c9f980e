"""Toxicity: a factorization machine over hashed terms, which weighs terms and learns how pairs of them act together."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftline.llm.common import PLAIN_BYTES, id_remainder, utf8

#: Hash buckets of terms; buckets the model looks at; factors per bucket.
BUCKETS, TERMS, FACTORS = 1 << 22, 1024, 8
#: Labelled documents the model is fitted on at most: those with the smallest hashes of their ids.
TRAINING_ROWS = 16_384
#: Words this long also count by their first bytes, so that one stem with many endings is one term.
STEM = 5
#: Weights decay less than factors: a term that tells alone gets a weight, and factors are left what pairs add.
STEPS, RATE, DECAY, FACTOR_DECAY = 800, 0.05, 2e-6, 3e-4


def buckets(body: bytes) -> set[int]:
    """Hash buckets of the distinct words and stems of a UTF-8 text."""
    words = set(body.translate(PLAIN_BYTES).split())
    stems = {w[:STEM] + b"*" for w in words if len(w) > STEM}
    return {zlib.crc32(t) & (BUCKETS - 1) for t in words | stems}


@dataclass
class FactorizationMachine:
    """score = sigmoid(bias + sum of weights + half of ((sum of factors) squared - sum of squared factors))."""

    terms: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def scores(self, bodies: Iterator[bytes]) -> np.ndarray:
        place = dict(zip(self.terms.tolist(), range(len(self.terms))))
        known, out = place.keys(), []
        for body in bodies:
            i = [place[t] for t in known & buckets(body)]
            v = self.factors[i]
            pairs = 0.5 * ((v.sum(0) ** 2).sum() - (v**2).sum()) if i else 0.0
            out.append(self.bias + self.weights[i].sum() + pairs)
        return 1 / (1 + np.exp(-np.clip(np.array(out, float), -30, 30)))


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Logistic loss with decay, minimised over all rows in fixed steps (Adam); the start is seeded, so fits agree."""
    rate = (y.sum() + 0.5) / (len(y) + 2)
    rng = np.random.default_rng(7)
    p = [np.array([np.log(rate / (1 - rate))]), np.zeros(x.shape[1]), rng.normal(0, 0.01, (x.shape[1], FACTORS))]
    m, s = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    x = x.astype(np.float32)
    for step in range(1, STEPS + 1 if len(y) and 0 < y.sum() < len(y) else 1):
        v = p[2].astype(np.float32)
        sums = x @ v
        z = p[0] + x @ p[1].astype(np.float32) + 0.5 * ((sums**2).sum(1) - x @ (v**2).sum(1))
        e = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)).astype(np.float32)
        xe = x.T @ e
        g = [np.array([e.sum()]), xe + DECAY * p[1], x.T @ (e[:, None] * sums) - xe[:, None] * v + FACTOR_DECAY * p[2]]
        for k in range(3):
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            s[k] = 0.999 * s[k] + 0.001 * g[k] ** 2
            p[k] = p[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
    return float(p[0][0]), p[1], p[2]


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> FactorizationMachine:
    """A model of ``labels.toxic`` from the texts of at most ``rows`` labelled documents whose id remainder is not 0.

    An id with several labels counts as toxic if one of them says so; null labels and ids are left out. The terms are the
    ``TERMS`` buckets whose presence tells most about the label. The fit is one task over the bounded sample.
    """
    spark = docs.sparkSession
    usable = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(id_remainder(F.col("doc_id")) != 0)
    chosen = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = docs.select("doc_id", utf8(F.col("text")).alias("body")).join(F.broadcast(chosen), "doc_id").select("y", "body")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(buckets(b.as_py())) for b in batch.column("body")]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(terms, pa.list_(pa.int32()))], names=["y", "terms"])

    hashed_rows = sample.mapInArrow(hashed, "y int, terms array<int>")
    totals = sample.agg(F.count("y").alias("n"), F.sum("y").alias("pos")).first()
    n, pos = totals.n, totals.pos or 0
    per_term = hashed_rows.select("y", F.explode("terms").alias("term")).groupBy("term").agg(F.count("y").alias("c"), F.sum("y").alias("t"))
    # Likelihood ratio of presence against the label, from the four counts.
    cells = [(F.col("t"), F.col("c") * pos / max(n, 1)), (F.col("c") - F.col("t"), F.col("c") * (n - pos) / max(n, 1))]
    cells += [(pos - F.col("t"), (n - F.col("c")) * pos / max(n, 1)), (n - F.col("c") - pos + F.col("t"), (n - F.col("c")) * (n - pos) / max(n, 1))]
    gain = sum(F.when((o > 0) & (e > 0), o * F.log(o / e)).otherwise(0.0) for o, e in cells)
    best = per_term.filter("c >= 3").orderBy(F.desc(gain), "term").limit(TERMS).select("term")
    terms = np.sort(np.array([r.term for r in best.collect()], np.int64))
    held = spark.sparkContext.broadcast(terms)

    def narrowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = dict(zip(held.value.tolist(), range(len(held.value))))
        for batch in batches:
            found = [sorted(place[t] for t in place.keys() & buckets(b.as_py())) for b in batch.column("body")]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(found, pa.list_(pa.int32()))], names=["y", "terms"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y, found = [], []
        for batch in batches:
            y += batch.column("y").to_pylist()
            found += batch.column("terms").to_pylist()
        order = sorted(range(len(y)), key=lambda k: (y[k], found[k]))  # the same fit in whatever order rows arrive
        x = np.zeros((len(y), len(held.value)), np.float32)
        for k, row in enumerate(order):
            x[k, found[row]] = 1
        bias, weights, factors = _fit(x, np.array([y[k] for k in order], float))
        whole = np.concatenate(([bias], weights, factors.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array([whole.tolist()], pa.list_(pa.float64()))], names=["model"])

    schema = "y int, terms array<int>"
    model = sample.mapInArrow(narrowed, schema).repartition(1).mapInArrow(train, "model array<double>").first()
    if model is None:
        return FactorizationMachine(terms, -1.0, np.zeros(len(terms)), np.zeros((len(terms), FACTORS)))
    whole, k = np.array(model.model), len(terms)
    return FactorizationMachine(terms, whole[0], whole[1 : k + 1], whole[k + 1 :].reshape(k, FACTORS))


def scored(docs: DataFrame, model: FactorizationMachine) -> DataFrame:
    """doc_id and score of every row; null and empty texts get the score of the bias alone. The model has a fixed size."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.scores(b.as_py() for b in batch.column("body"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return docs.select("doc_id", utf8(F.col("text")).alias("body")).mapInArrow(run, "doc_id long, score double")
