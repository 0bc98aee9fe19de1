"""Benchmark decontamination (2): a prefix-filtered set join, verified exactly.

A window is ten consecutive words of an item (all of a shorter item). To hold a
window a document must hold its rarest word, so that word alone is its prefix:

1. one pass counts the items' words over all documents (order by rarity);
2. each window is indexed under its rarest word, with the word's place in it;
3. one pass looks up every document word; a hit at place ``i`` of a word that
   stands at ``j`` of a window allows only the start ``i - j`` (positional
   bound), which must leave room for the window inside the document (length
   bound); the words there are then compared with the window's, one by one, as
   64-bit hashes.

The items are searched in blocks of at most ``BLOCK_BYTES`` of text, each block
being one pass over the documents, so what is collected and broadcast at once is
bounded whatever the size of the benchmark. Documents are never shuffled.

Defined results: a NULL or blank text has no words and is clean; an item without
words is never found; items with equal texts are all listed; an item without an
id marks words but is not listed; repeated rows give repeated results; extra
columns are ignored; empty tables of either kind give clean documents or none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ._tokens import ALNUM, chunks, words

#: Words of a window.
WINDOW = 10
#: Item text that one pass holds in memory; a larger benchmark takes several passes.
BLOCK_BYTES = 4 << 20
#: Candidate places that are verified at once.
SLICE = 1 << 18
_BITS = 20


class _Lookup:
    """Positions of values in a sorted array of distinct 64-bit hashes, behind a bit table."""

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values)
        self.table = np.zeros(1 << _BITS, bool)
        self.table[(self.values >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices into ``h`` that are found, and their places among the values."""
        maybe = np.flatnonzero(self.table[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
        if not len(self.values):
            return maybe[:0], maybe[:0]
        at = np.minimum(np.searchsorted(self.values, h[maybe]), len(self.values) - 1)
        good = self.values[at] == h[maybe]
        return maybe[good], at[good]


def _windows(texts: list[str], width: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: the windows' word hashes (a row for each) and the numbers of their items."""
    out: dict[int, tuple[list, list]] = {}
    base = 0
    for lo, hi, buf, off in chunks(pa.array(texts, pa.string())):
        h, first, *_ = words(buf, off, ALNUM)
        for i in range(hi - lo):
            own = h[first[i]: first[i + 1]]
            if len(own):
                n = min(width, len(own))
                rows, items = out.setdefault(n, ([], []))
                rows.append(np.lib.stride_tricks.sliding_window_view(own, n))
                items += [base + lo + i] * (len(own) - n + 1)
    return {n: (np.concatenate(rows), np.array(items)) for n, (rows, items) in out.items()}


class _Index:
    """The windows of one length, under their rarest words."""

    def __init__(self, rows: np.ndarray, items: np.ndarray, vocabulary: np.ndarray, counts: np.ndarray):
        self.rows, inverse = np.unique(rows, axis=0, return_inverse=True)
        inverse = inverse.ravel()
        pairs = np.unique(np.stack([inverse, items], axis=1), axis=0)
        self.item_ptr = np.searchsorted(pairs[:, 0], np.arange(len(self.rows) + 1))
        self.item_of = pairs[:, 1]
        rarity = counts[np.searchsorted(vocabulary, self.rows)]
        self.place = rarity.argmin(axis=1)
        token = self.rows[np.arange(len(self.rows)), self.place]
        self.lookup = _Lookup(token)
        which = np.searchsorted(self.lookup.values, token)
        self.entries = np.argsort(which, kind="stable")
        self.ptr = np.searchsorted(which[self.entries], np.arange(len(self.lookup.values) + 1))

    def search(self, h: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Verified ``(document, start, window)`` arrays."""
        width = self.rows.shape[1]
        at, token = self.lookup.find(h)
        fan = self.ptr[token + 1] - self.ptr[token]
        cut = np.searchsorted(np.cumsum(fan), np.arange(SLICE, int(fan.sum()) + SLICE, SLICE)) + 1 if len(at) else []
        for lo, hi in zip([0, *cut[:-1]], cut, strict=False):
            n = fan[lo:hi]
            if not n.sum():
                continue
            entry = np.repeat(self.ptr[token[lo:hi]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            window = self.entries[entry]
            place = np.repeat(at[lo:hi], n)
            start = place - self.place[window]
            doc = np.searchsorted(first, place, side="right") - 1
            room = (start >= first[doc]) & (start + width <= first[doc + 1])
            doc, start, window = doc[room], start[room], window[room]
            for j in range(width):  # most fail at the first words
                same = h[start + j] == self.rows[window, j]
                doc, start, window = doc[same], start[same], window[same]
            yield doc, start, window


def _counts(docs: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """How often each word of the vocabulary stands in the documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(shared.value)
        total = np.zeros(len(lookup.values), np.int64)
        for batch in batches:
            for _, _, buf, off in chunks(batch.column("text")):
                _, at = lookup.find(words(buf, off, ALNUM)[0])
                total += np.bincount(at, minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["word", "n"])

    rows = docs.select("text").mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(len(vocabulary), np.int64)
    for r in rows:  # bounded by the words of one block
        counts[r["word"]] = r["n"]
    return counts


def _index(docs: DataFrame, texts: list[str], width: int) -> list[_Index]:
    """The indexes of one block of items, one for each length of window; counts the block's words in all ``docs``."""
    windows = _windows(texts, width)
    vocabulary = np.unique(np.concatenate([rows.ravel() for rows, _ in windows.values()] or [np.zeros(0, np.uint64)]))
    counts = _counts(docs, vocabulary) if len(vocabulary) else np.zeros(0, np.int64)
    return [_Index(rows, items, vocabulary, counts) for rows, items in windows.values()]


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[tuple[list[str], list[str | None]]]:
    """Texts and ids of the items, in blocks of about ``block_bytes`` bytes."""
    items = items.select(F.col("item_id").cast("string").alias("item_id"), "text").filter(F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    for n in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == n).collect()
        yield [r["text"] for r in rows], [r["item_id"] for r in rows]


def _pass(docs: DataFrame, texts: list[str], ids: list[str | None], width: int) -> DataFrame:
    """``doc_id, t, n_words, spans, items`` of every document against one block of items."""
    shared = docs.sparkSession.sparkContext.broadcast((_index(docs, texts, width), ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, ids = shared.value
        for batch in batches:
            for lo, hi, buf, off in chunks(batch.column("text")):
                h, first, *_ = words(buf, off, ALNUM)
                spans, items = [[] for _ in range(hi - lo)], [set() for _ in range(hi - lo)]
                for one in index:
                    for doc, start, window in one.search(h, first):
                        for d, s, w in zip(doc.tolist(), start.tolist(), window.tolist(), strict=True):
                            s -= int(first[d])
                            end = s + one.rows.shape[1]
                            if spans[d] and spans[d][-1]["from"] <= s <= spans[d][-1]["to"] <= end:
                                spans[d][-1]["to"] = end
                            else:
                                spans[d].append({"from": s, "to": end})
                            items[d].update(one.item_of[one.item_ptr[w]: one.item_ptr[w + 1]].tolist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), batch.column("t").slice(lo, hi - lo), pa.array(np.diff(first), pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))),
                     pa.array([sorted({ids[i] for i in own if ids[i] is not None}) for own in items], pa.list_(pa.string()))],
                    ["doc_id", "t", "n_words", "spans", "items"])

    return docs.mapInArrow(run, "doc_id bigint, t bigint, n_words bigint, spans array<struct<from:bigint,to:bigint>>, items array<string>")


def contamination(docs: DataFrame, items: DataFrame, width: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_words, spans, items``: which words of each document lie in windows of which items.

    ``docs(doc_id, text)``, ``items(item_id, text)``; ``spans`` are stretches
    ``[from, to)`` of words and may overlap.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    docs = docs.withColumn("t", F.xxhash64("text"))
    found = [_pass(docs, texts, ids, width) for texts, ids in _blocks(items, block_bytes)]
    blocks = len(found)
    if blocks == 1:
        return found[0].drop("t")
    every = found[0]
    for other in found[1:]:
        every = every.union(other)
    one = every.groupBy("doc_id", "t").agg(F.first("n_words").alias("n_words"), F.collect_set("spans").alias("spans"),
                                           F.collect_set("items").alias("items"), (F.count("*") / blocks).cast("int").alias("copies"))
    return (one.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
            .select("doc_id", "n_words", F.flatten("spans").alias("spans"), F.array_sort(F.array_distinct(F.flatten("items"))).alias("items")))


def clean(docs: DataFrame, items: DataFrame, width: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no window of any item."""
    for texts, _ in _blocks(items, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(_index(docs, texts, width))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good = np.ones(batch.num_rows, bool)
                for lo, _, buf, off in chunks(batch.column("text")):
                    h, first, *_ = words(buf, off, ALNUM)
                    for one in shared.value:
                        for doc, _, _ in one.search(h, first):
                            good[lo + doc] = False
                yield batch.filter(pa.array(good))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row for each document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    found = contamination(docs, items)
    hit = F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["from"], s["to"] - 1)))))
    return found.select("doc_id", "n_words", hit.cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op2_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    return report(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: a document that holds a window of any benchmark item goes."""
    return clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE_SQL = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
item AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item_id, n, w[p + 1 : p + n] AS k
        FROM (SELECT item_id, w, least({WINDOW}, len(w)) AS n, unnest(range(len(w) - least({WINDOW}, len(w)) + 1)) AS p FROM item WHERE len(w) > 0)),
place AS (SELECT r, p, n, w[p + 1 : p + n] AS k
          FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS p FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT r, p, place.n AS n, item_id FROM place JOIN win ON place.n = win.n AND place.k = win.k),
word AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS p FROM hit) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (r) LEFT JOIN named USING (r)
"""
