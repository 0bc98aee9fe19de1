"""Quality classifier (8): random-indexing word vectors, pooled, and a two-layer network.

Every word bucket has a sparse random index vector. A bucket's word vector is the
sum of the index vectors of the words within ``REACH`` places of it, counted over
all documents: each task adds up one matrix of fixed size, and the matrices are
added up again in blocks of rows. A document is described by the weighted mean
and spread of its words' unit vectors (frequent words weigh less). A network with
one hidden layer, fitted in numpy on a bounded sample of labelled rows, maps this
to a logit, whose temperature is fitted on rows the network has not seen.

Words are runs of letters and digits, or of punctuation marks; words in capitals
are words of their own.

Defined results: a NULL or blank text has a zero vector and the score that the
network gives it; without usable labels of both classes every score is the share
of label 1 (0.5 without any); repeated rows are equal; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ._labels import labelled, remainder
from ._tokens import byte_class, chunks, hashes, mix

#: Word buckets, dimensions, non-zero places of an index vector, and places of context on either side.
BUCKETS, SIZE, PLACES, REACH = 1 << 13, 48, 4, 2
#: Labelled documents of each class that the network is fitted on.
LABELLED = 4000
HIDDEN, ROUNDS, BATCH, RATE, DECAY = 32, 60, 256, 3e-3, 1e-4
#: A word's weight is a / (a + its share of all words).
COMMON = 1e-3
THRESHOLD = 0.5
HELD_OUT, FOLDS = 1, 3
#: Rows of the matrix that are added up together.
ROWS = 256

_WORD = byte_class(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
_SPACE = byte_class(lambda b: b <= 32 or b == 127)
_CAPITAL = byte_class(lambda b: 65 <= b <= 90)
_SMALL = byte_class(lambda b: 97 <= b <= 122)


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of every bucket's index vector."""
    draw = mix(np.arange(1, BUCKETS * PLACES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(BUCKETS, PLACES)
    return (draw % np.uint64(SIZE)).astype(np.int64), np.where(draw >> np.uint64(63), 1.0, -1.0)


def buckets(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every word, and each document's first word (one more entry at the end)."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    word, space = _WORD[buf], _SPACE[buf]
    change = np.ones(n + 1, bool)
    change[1:n] = (word[1:] != word[:-1]) | space[1:] | space[:-1]
    change[off] = True
    s = np.flatnonzero(change[:n] & ~space)
    e = np.flatnonzero(change[1:] & ~space) + 1
    big = np.concatenate([[0], np.cumsum(_CAPITAL[buf])])
    small = np.concatenate([[0], np.cumsum(_SMALL[buf])])
    shout = (big[e] - big[s] > 1) & (small[e] == small[s])
    h = mix(hashes(buf, s, e) + shout.astype(np.uint64))
    return (h >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64), np.searchsorted(s, off)


def word_vectors(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Unit word vectors of all buckets, and their weights, from all documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sign = _index_vectors()
        total = np.zeros((BUCKETS, SIZE + 1))
        for batch in batches:
            for _, _, buf, off in chunks(batch.column("text")):
                b, first = buckets(buf, off)
                doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
                total[:, SIZE] += np.bincount(b, minlength=BUCKETS)
                for d in range(1, REACH + 1):
                    near = np.flatnonzero(doc[d:] == doc[:-d])
                    for x, y in ((b[near], b[near + d]), (b[near + d], b[near])):
                        at = (x * SIZE)[:, None] + place[y]
                        total[:, :SIZE] += np.bincount(at.ravel(), sign[y].ravel(), BUCKETS * SIZE).reshape(BUCKETS, SIZE)
        for lo in range(0, BUCKETS, ROWS):
            part = total[lo: lo + ROWS]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([lo], pa.int32()), pa.array([part.astype(np.float32).tobytes()], pa.binary())], ["row", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for lo, part in zip(batch.column("row").to_pylist(), batch.column("part").to_pylist(), strict=True):
                total[lo] = total.get(lo, 0.0) + np.frombuffer(part, np.float32).astype(np.float64)
        for lo, part in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([lo], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["row", "part"])

    parts = docs.select("text").mapInArrow(count, "row int, part binary")
    summed = parts.repartition(BUCKETS // ROWS, "row").mapInArrow(add, "row int, part binary").collect()  # one matrix of fixed size
    total = np.zeros((BUCKETS, SIZE + 1))
    for r in summed:
        total[r["row"]: r["row"] + ROWS] = np.frombuffer(r["part"]).reshape(-1, SIZE + 1)
    vectors, n = total[:, :SIZE], total[:, SIZE]
    vectors = vectors - (vectors.sum(axis=0) / max(n.sum(), 1.0)) * n[:, None]  # without what all words share
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    weight = COMMON / (COMMON + n / max(n.sum(), 1.0))
    return (vectors / np.where(length > 0, length, 1.0)).astype(np.float32), weight.astype(np.float32)


def pooled(vectors: np.ndarray, weight: np.ndarray, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Weighted mean and spread of each document's word vectors, and the plain mean."""
    b, first = buckets(buf, off)
    out = np.zeros((len(off) - 1, 3 * SIZE))
    have = np.flatnonzero(first[:-1] < first[1:])
    if not len(have):
        return out
    begin, n = first[:-1][have], np.diff(first)[have][:, None]
    w = weight[b][:, None]
    total = np.add.reduceat(w[:, 0], begin)[:, None]
    v = vectors[b]
    out[have, 2 * SIZE:] = np.add.reduceat(v, begin) / n
    v *= w
    mean = np.add.reduceat(v, begin) / total
    v *= vectors[b]
    out[have, :SIZE] = mean
    out[have, SIZE: 2 * SIZE] = np.sqrt(np.maximum(np.add.reduceat(v, begin) / total - mean * mean, 0))
    return out


class Network:
    """Scaled inputs, a hidden layer, a logit and its temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray):
        random = np.random.default_rng(8)
        self.centre, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        test = random.random(len(y)) < 0.2
        if len(set(y[test])) < 2 or len(set(y[~test])) < 2:
            test[:] = False
        a, t, w = (x[~test] - self.centre) / self.scale, y[~test], weight[~test]
        p = [random.normal(0, 1 / np.sqrt(a.shape[1]), (a.shape[1], HIDDEN)), np.zeros(HIDDEN), random.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        m, v, step = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p], 0
        for _ in range(ROUNDS):
            order = random.permutation(len(t))
            for lo in range(0, len(t), BATCH):
                i = order[lo: lo + BATCH]
                hidden = np.tanh(a[i] @ p[0] + p[1])
                error = w[i] * (1 / (1 + np.exp(-np.clip(hidden @ p[2] + p[3], -30, 30))) - t[i]) / len(i)
                back = np.outer(error, p[2]) * (1 - hidden * hidden)
                grads = [a[i].T @ back + DECAY * p[0], back.sum(axis=0), hidden.T @ error + DECAY * p[2], np.array([error.sum()])]
                step += 1
                for k, g in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    p[k] = p[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        self.layers, self.temperature = p, 1.0
        held = test if test.any() else np.ones(len(y), bool)
        z, t, w = self.logits(x[held]), y[held], weight[held]
        loss = {q: float(np.sum(w * np.logaddexp(0, np.where(t > 0, -z, z) / q))) for q in np.geomspace(0.25, 8, 41)}
        self.temperature = min(loss, key=loss.get)

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.centre) / self.scale @ self.layers[0] + self.layers[1])
        return (hidden @ self.layers[2] + self.layers[3]) / self.temperature

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


class Model:
    """Frozen word vectors with a network, or one score for all."""

    def __init__(self, vectors: np.ndarray, weight: np.ndarray, network: Network | None, prior: float):
        self.vectors, self.weight, self.network, self.prior = vectors, weight, network, prior

    def scores(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        if self.network is None:
            return np.full(len(off) - 1, self.prior)
        return self.network.scores(pooled(self.vectors, self.weight, buf, off))


def learn(docs: DataFrame, labels: DataFrame, bound: int = LABELLED) -> Model:
    """Word vectors of all documents, and a network from about ``bound`` labelled ones of each class at most."""
    vectors, weight = word_vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast((vectors, weight))
    sample = labelled(docs, labels, "quality", HELD_OUT, FOLDS, bound)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, off in chunks(batch.column("text")):
                x = pooled(*shared.value, buf, off).astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), batch.column("label").slice(lo, hi - lo)], ["x", "y"])

    # In an order of their own, so the fit does not depend on the partitions.
    rows = sample.mapInArrow(run, "x binary, y int").orderBy("x").collect()  # bounded by the sample
    y = np.array([float(r["y"] == 1) for r in rows])
    # Thinned classes count as much as in the labels.
    real = {r["one"]: r["count"] for r in labels.filter(F.col("quality").isNotNull() & (remainder(F.col("doc_id"), FOLDS) != HELD_OUT))
            .groupBy((F.col("quality") == 1).alias("one")).count().collect()}
    prior = real.get(True, 0) / sum(real.values()) if real else 0.5
    if len(set(y.tolist())) < 2:
        return Model(vectors, weight, None, prior)
    x = np.array([np.frombuffer(r["x"], np.float32) for r in rows], np.float64)
    share = np.where(y > 0, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    return Model(vectors, weight, Network(x, y, share), prior)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of each row of ``docs(doc_id, text)``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = [shared.value.scores(buf, off) for _, _, buf, off in chunks(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(score) if score else [], pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, score double")


def op8_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored(docs, model).select("doc_id", (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
                                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
