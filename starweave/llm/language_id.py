"""Language ID (3): prediction by partial matching over bytes.

For each language a context tree of up to ``ORDER`` bytes is counted on a
bounded sample of labelled documents, then frozen. A byte costs ``-log2`` of its
probability in the longest known context; where the context has not been followed
by it, the escape is paid and the next shorter context asked, down to eight bits
for a byte never seen (escape method C: as many escapes as different followers).
The language of least total code length is the prediction; the score is its
share of ``2 ** -bits``, the bits being scaled to ``SCORE_BYTES`` bytes.

All code lengths are worked out once, so a byte takes one lookup of its longest
gram, which holds the costs in all languages. Letters are lower-cased and other
ASCII characters are one separator, whose repetitions cost nothing.

Defined results: NULL, and text without a letter, is ``und`` with score 0, as is
everything if no language can be learned; ties go to the first language by name;
rows without a language are not learned from; repeated rows are equal; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ._labels import remainder
from ._tokens import Memo, byte_class, chunks, mix

#: Bytes of context at most.
ORDER = 4
#: Labelled documents of a language that its tree is learned from, about, at most.
LABELLED = 2000
#: A gram of more than three bytes is kept if it was seen so often.
SEEN = 2
SCORE_BYTES = 64
HELD_OUT, FOLDS = 2, 4

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[~byte_class(lambda b: 97 <= b <= 122 or b >= 128)] = 32


def prepared(text):
    """Lower case behind ``ORDER`` separators, so no context reaches into another document."""
    return F.concat(F.lit(" " * ORDER), F.lower(F.coalesce(text, F.lit(""))))


def grams(buf: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """The places that count, and the code of the ``longest`` bytes that end at each (the last byte lowest)."""
    b = _FOLD[buf]
    at = np.arange(longest - 1, len(b))
    at = at[(b[at] != 32) | (b[at - 1] != 32)]
    code = np.zeros(len(at), np.uint64)
    for j in range(longest - 1, -1, -1):
        code = (code << np.uint64(8)) | b[at - j]
    return at, code


def _cut(code: np.ndarray, n: int) -> np.ndarray:
    return code & np.uint64((1 << (8 * n)) - 1)


def _key(code: np.ndarray, n: int) -> np.ndarray:
    return mix(code * np.uint64(16) + np.uint64(n))


class _Tree:
    """Grams of one length: their codes, ascending, and counts by language; costs of escapes by context."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        self.codes, self.counts = codes, counts.astype(np.float64)
        self.contexts, of = np.unique(codes >> np.uint64(8), return_inverse=True)
        shape = (len(self.contexts), counts.shape[1])
        self.n, self.u = np.zeros(shape), np.zeros(shape)
        np.add.at(self.n, of, self.counts)
        np.add.at(self.u, of, self.counts > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            self.escape = np.where(self.n > 0, np.log2((self.n + self.u) / self.u), 0.0)
            self.cost = np.where(self.counts > 0, np.log2((self.n + self.u)[of] / self.counts), -1.0)


def _found(sorted_codes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    if not len(sorted_codes):
        return np.full(len(codes), -1)
    at = np.minimum(np.searchsorted(sorted_codes, codes), len(sorted_codes) - 1)
    return np.where(sorted_codes[at] == codes, at, -1)


def _costs(trees: list[_Tree], n: int, codes: np.ndarray, languages: int) -> np.ndarray:
    """Code lengths of the last byte of grams of ``n`` bytes, in all languages."""
    if not n:
        return np.full((len(codes), languages), 8.0)
    tree, shorter = trees[n - 1], _costs(trees, n - 1, _cut(codes, n - 1), languages)
    context = _found(tree.contexts, codes >> np.uint64(8))
    known = context >= 0
    shorter[known] += tree.escape[context[known]]
    gram = _found(tree.codes, codes)
    have = np.flatnonzero(gram >= 0)
    own = tree.cost[gram[have]]
    shorter[have] = np.where(own >= 0, own, shorter[have])
    return shorter


class Model:
    """Frozen code lengths: for every known gram its cost, and for every known context its escape."""

    def __init__(self, languages: list[str], counted: dict[int, tuple[np.ndarray, np.ndarray]]):
        self.languages = languages
        trees = [_Tree(*counted[n]) for n in range(1, ORDER + 2)]
        self.rows, keys = [], []
        for n, tree in enumerate(trees, 1):
            self.rows.append(_costs(trees, n, tree.codes, len(languages)))
            keys.append(_key(tree.codes, n))
        for n, tree in enumerate(trees, 1):
            self.rows.append(tree.escape)
            keys.append(_key(tree.contexts, n + 8))
        self.rows = np.concatenate(self.rows).astype(np.float32)
        self.keys = np.concatenate(keys)
        self.memo: Memo | None = None

    def __getstate__(self):
        return self.__dict__ | {"memo": None}

    def bits(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code length of each document in each language, and its bytes that count."""
        if self.memo is None:
            self.memo = Memo(len(self.keys))
            self.memo.put(self.keys, np.arange(len(self.keys), dtype=np.int32))
        at, code = grams(buf, ORDER + 1)
        total = np.zeros((len(at), len(self.languages)), np.float32)
        left = np.arange(len(at))
        for n in range(ORDER + 1, 0, -1):
            own = _cut(code[left], n)
            row = self.memo.find(_key(own, n))
            hit = row >= 0
            total[left[hit]] += self.rows[row[hit]]
            left, own = left[~hit], own[~hit]
            row = self.memo.find(_key(own >> np.uint64(8), n + 8))
            known = row >= 0
            total[left[known]] += self.rows[row[known]]
        total[left] += 8
        ends = np.searchsorted(at, off)
        run = np.concatenate([np.zeros((1, total.shape[1])), np.cumsum(total, axis=0, dtype=np.float64)])
        return run[ends[1:]] - run[ends[:-1]], np.diff(ends)


def learn(docs: DataFrame, bound: int = LABELLED) -> Model | None:
    """Trees from about ``bound`` documents of each language at most, none of the held-out fold."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder(F.col("doc_id"), FOLDS) != HELD_OUT))
    size = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    languages = sorted(size)
    if not languages:
        return None
    of = F.create_map(*[x for i, k in enumerate(languages) for x in (F.lit(k), F.struct(F.lit(i).alias("i"), F.lit(min(1.0, bound / size[k])).alias("share")))])
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    sample = (usable.withColumn("of", of[F.col("lang")]).filter(draw < F.col("of.share"))
              .groupBy(F.md5("text").alias("m")).agg(F.first("text").alias("text"), F.min("of.i").alias("i")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("i").to_numpy()
            for lo, hi, buf, off in chunks(batch.column("text")):
                at, code = grams(buf, ORDER + 1)
                lang = label[lo:hi][np.searchsorted(off, at, side="right") - 1].astype(np.uint64)
                for n in range(1, ORDER + 2):
                    both, count = np.unique((_cut(code, n) << np.uint64(16)) | lang, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(both), n), pa.int32()), pa.array((both >> np.uint64(16)).astype(np.int64)),
                                                      pa.array((both & np.uint64(65535)).astype(np.int32)), pa.array(count)], ["n", "code", "i", "c"])

    counts = (sample.select(prepared(F.col("text")).alias("text"), "i").mapInArrow(run, "n int, code bigint, i int, c bigint")
              .groupBy("n", "code", "i").agg(F.sum("c").alias("c")).filter((F.col("n") <= 3) | (F.col("c") >= SEEN)).toArrow())
    n, code, i, c = (counts.column(x).to_numpy() for x in ("n", "code", "i", "c"))
    counted = {}
    for k in range(1, ORDER + 2):
        own = n == k
        codes, at = np.unique(code[own].astype(np.uint64), return_inverse=True)
        table = np.zeros((len(codes), len(languages)))
        table[at, i[own]] = c[own]
        counted[k] = codes, table
    return Model(languages, counted)


def predicted(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, lang_pred, score`` of each row of ``docs(doc_id, text)``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), prepared(F.col("text")).alias("text"),
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    if model is None:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, "und"], object)
        for batch in batches:
            letter = batch.column("letter").to_numpy(zero_copy_only=False)
            for lo, hi, buf, off in chunks(batch.column("text"), max(1 << 16, (4 << 20) // max(4, len(model.languages)))):
                bits, size = model.bits(buf, off)
                best = bits.argmin(axis=1)
                scale = np.minimum(1.0, SCORE_BYTES / np.maximum(size, 1))[:, None]
                score = 1 / np.exp2(-(bits - bits.min(axis=1, keepdims=True)) * scale).sum(axis=1)
                some = letter[lo:hi]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(names[np.where(some, best, -1)], pa.string()),
                                                  pa.array(np.where(some, score, 0.0))], ["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return predicted(docs, learn(docs)).select("doc_id", (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
