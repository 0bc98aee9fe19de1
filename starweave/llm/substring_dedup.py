"""Substring dedup (4): paragraph MinHash banding, exact Jaccard, components.

Two kinds of paragraph are compared over all documents:

* lines of ``LINE_WORDS`` words or more, by MinHash bands of ``BANDS`` times
  ``ROWS`` coordinates (99.8 % of pairs at the threshold meet, and 99.99 % of
  those at 0.85); lines that meet are joined and verified by the exact Jaccard of
  their whole sets of five-word shingles;
* every run of ``SPAN_WORDS`` words, wherever it stands (a line end is no border),
  by equal words. The smallest of a run's ``GRAM``-word hashes is its anchor: equal
  runs have equal anchors, and neighbours that share one are a stretch, the unit
  that is shuffled. Anchors of a single place are left out. Where all stretches of
  an anchor are equal, so are their runs; else the runs of one stretch of each kind
  are compared. So every passage of ``SPAN_WORDS`` words or more that stands in two
  places is found, word by word.

A component's first paragraph, by ``doc_id``, then the text's hash, then place,
stays; the others are removals, but for words that a run shares with its own first
place. Removals of a document are merged, and stretches of ``SPAN_WORDS`` words or
more are reported, with the documents that keep them.

Defined results: a NULL or blank text has no paragraphs; a NULL ``doc_id`` comes
first; rows that repeat id and text are one document; extra columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ._cluster import kept, small_side
from ._linking import link
from ._tokens import NOT_SPACE, chunks, mix, shingles, words

SHINGLE, JACCARD = 5, 0.75
#: Words of a line that is compared by MinHash, at least.
LINE_WORDS = 20
BANDS, ROWS = 14, 3
#: Words of a reported stretch, at least, and of the pieces whose smallest hash anchors a run.
SPAN_WORDS, GRAM = 20, 8
_NO_ID = -(1 << 63)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _signature(g: np.ndarray, begins: np.ndarray, size: int) -> np.ndarray:
    """MinHash coordinates, each from a mixer of its own, of the sets that begin at ``begins``."""
    out = np.empty((len(begins), size), np.uint32)
    low = (g >> np.uint64(32)).astype(np.uint32)
    for k in range(size):
        seed = int(mix(np.array([k + 1], np.uint64))[0])
        x = low * np.uint32(seed & 0xFFFFFFFF | 1)
        x ^= x >> np.uint32(15)
        x *= np.uint32(seed >> 32 | 1)
        x ^= x >> np.uint32(13)
        out[:, k] = np.minimum.reduceat(x, begins)
    return out


def _sequence_hash(h: np.ndarray, lo: np.ndarray, hi: np.ndarray, seed: np.uint64) -> np.ndarray:
    """A 64-bit hash of each run of words ``h[lo:hi]``."""
    base = int(seed) | 1
    up, down = np.full(len(h) + 1, base, np.uint64), np.full(len(h) + 1, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    up, down = np.cumprod(up), np.cumprod(down)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(mix(h ^ seed) * up[:-1], out=total[1:])
    return mix((total[hi] - total[lo]) * down[lo] + (hi - lo).astype(np.uint64))


def _lines(buf: np.ndarray, off: np.ndarray, h: np.ndarray, first: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines of enough words: their document, first word and end word."""
    ends = np.unique(np.concatenate([off[1:], np.flatnonzero(buf == 10)]))
    at = np.searchsorted(s, ends)
    lo = np.concatenate([[0], at[:-1]])
    # A line may follow the end of a document without words between.
    keep = at - lo >= LINE_WORDS
    lo, hi = lo[keep], at[keep]
    return np.searchsorted(first, lo, side="right") - 1, lo, hi


def _anchors(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of ``SPAN_WORDS`` words inside a document: document, first word, place of the anchor (the last smallest)."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    place = np.flatnonzero(np.arange(len(h)) + SPAN_WORDS <= first[doc + 1]) if len(h) else np.zeros(0, np.int64)
    if not len(place):
        return place, place, place
    begin = np.arange(len(h) - GRAM + 1)
    g = _sequence_hash(h, begin, begin + GRAM, _A)
    # Pieces across the border of two documents lie in no run that is kept.
    low, at, span = g, begin, 1
    while span < SPAN_WORDS - GRAM + 1:  # the smallest of twice as many pieces, from two that overlap or touch
        step = min(span, SPAN_WORDS - GRAM + 1 - span)
        later = low[step:] <= low[:-step]
        low, at = np.where(later, low[step:], low[:-step]), np.where(later, at[step:], at[:-step])
        span += step
    return doc[place], place, at[place]


def _paragraphs(docs: DataFrame, what: str) -> DataFrame:
    """What a scan of the whole texts gives: ``bands``, ``texts`` or ``members`` of lines, or ``anchors``: stretches of runs."""
    schema = {"bands": "cls binary, bands array<bigint>, sketch binary", "texts": "cls binary, text string",
              "members": "d bigint, t bigint, a bigint, b bigint, from int, to int",
              "anchors": "d bigint, t bigint, g bigint, s bigint, from int, to int"}[what]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, _, buf, off in chunks(batch.column("text")):
                h, first, s, e = words(buf, off, NOT_SPACE)
                if what == "anchors":
                    doc, place, at = _anchors(h, first)
                    if not len(doc):
                        continue
                    new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                    last = np.append(new[1:], len(at)) - 1
                    g, s = _sequence_hash(h, at[new], at[new] + GRAM, _A), _sequence_hash(h, place[new], place[last] + SPAN_WORDS, _B)
                    at_row, own = start + doc[new], first[doc[new]]
                    yield pa.RecordBatch.from_arrays([pa.array(batch.column("d").to_numpy()[at_row]), pa.array(batch.column("t").to_numpy()[at_row]), pa.array(g.view(np.int64)), pa.array(s.view(np.int64)),
                                                      pa.array((place[new] - own).astype(np.int32)), pa.array((place[last] - own + SPAN_WORDS).astype(np.int32))],
                                                     ["d", "t", "g", "s", "from", "to"])
                    continue
                doc, lo, hi = _lines(buf, off, h, first, s)
                if not len(doc):
                    continue
                a, b = _sequence_hash(h, lo, hi, _A), _sequence_hash(h, lo, hi, _B)
                if what == "members":
                    d = batch.column("d").to_numpy()[start + doc]
                    t = batch.column("t").to_numpy()[start + doc]
                    yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(t), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                                                      pa.array((lo - first[doc]).astype(np.int32)), pa.array((hi - first[doc]).astype(np.int32))],
                                                     ["d", "t", "a", "b", "from", "to"])
                    continue
                cls = pa.array([x.tobytes() for x in np.stack([a, b], axis=1).byteswap()], pa.binary())
                if what == "texts":
                    raw = buf.tobytes()
                    yield pa.RecordBatch.from_arrays([cls, pa.array([raw[x:y].decode(errors="replace") for x, y in zip(s[lo].tolist(), e[hi - 1].tolist(), strict=True)])], ["cls", "text"])
                    continue
                inside = np.zeros(len(h) + 1, np.int64)  # words of other lines have no part in shingles
                for x, y in zip(lo.tolist(), hi.tolist(), strict=True):
                    inside[x:y] = 1
                kept = np.flatnonzero(inside[:-1])
                edge = np.concatenate([[0], np.cumsum(hi - lo)])
                g, at = shingles(h[kept], edge, SHINGLE)
                sig = _signature(g, at[:-1], BANDS * ROWS)
                keys = np.zeros((len(sig), BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * _B
                for r in range(ROWS):
                    keys = mix(keys ^ sig[:, r::ROWS])
                flat = np.arange(0, len(sig) * BANDS + 1, BANDS, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([cls, pa.ListArray.from_arrays(pa.array(flat), pa.array(keys.ravel().view(np.int64))),
                                                  pa.array([x.tobytes() for x in (sig & np.uint32(255)).astype(np.uint8)], pa.binary())], ["cls", "bands", "sketch"])

    return docs.mapInArrow(run, schema)


def _runs(chosen: DataFrame) -> DataFrame:
    """``d, t, a, b, stretch, from``: the runs of ``SPAN_WORDS`` words in the stretches ``at`` of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("at")
            edge = column.offsets.to_numpy().astype(np.int64)
            begin, end = (column.values.field(k).to_numpy().astype(np.int64) for k in (0, 1))
            d, t = batch.column("d").to_numpy(), batch.column("t").to_numpy()
            for start, stop, buf, off in chunks(batch.column("text")):
                h, first, _, _ = words(buf, off, NOT_SPACE)
                mine = slice(edge[start], edge[stop])
                n = end[mine] - begin[mine] - SPAN_WORDS + 1
                row = np.repeat(np.repeat(np.arange(stop - start), np.diff(edge[start: stop + 1])), n)
                stretch = np.repeat(begin[mine], n)
                at = stretch + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                lo = first[row] + at
                a, b = (_sequence_hash(h, lo, lo + SPAN_WORDS, seed) for seed in (_A, _B))
                yield pa.RecordBatch.from_arrays([pa.array(d[start + row]), pa.array(t[start + row]), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                                                  pa.array(stretch.astype(np.int32)), pa.array(at.astype(np.int32))], ["d", "t", "a", "b", "stretch", "from"])

    return chosen.mapInArrow(run, "d bigint, t bigint, a bigint, b bigint, stretch int, from int")


def _later(d: str, t: str, begin: str, end: str, first: str) -> list[Column]:
    """The document and the words that a later copy loses; one that overlaps its first place leaves that place whole."""
    own = (F.col(d) == F.col(f"{first}.d")) & (F.col(t) == F.col(f"{first}.t"))
    # Runs move by as many places as their stretch.
    moved = F.when(own, F.greatest(F.lit(0), F.lit(SPAN_WORDS) - F.col(begin) + F.col(f"{first}.from"))).otherwise(F.lit(0))
    return [F.col(d).alias("d"), F.col(t).alias("t"), (F.col(begin) + moved).alias("from"), F.col(end).alias("to")]


def _repeated(whole: DataFrame) -> DataFrame:
    """``d, t, from, to, kept``: later copies of runs of ``SPAN_WORDS`` words, as stretches or single runs."""
    place = F.struct("d", "t", "from")
    often = (_paragraphs(whole, "anchors").groupBy("g").agg(F.count("*").alias("c"), (F.min("s") < F.max("s")).alias("mixed"))
             .filter("c > 1").select("g", "mixed"))
    found = kept(_paragraphs(whole, "anchors").join(often, "g"))
    kind = kept(found.groupBy("g", "s").agg(F.min(place).alias("first"), F.first("to").alias("any_to"), F.first("from").alias("any_from"),
                                                    F.first("mixed").alias("mixed"), F.count("*").alias("c"))
                        .select("g", "s", "first", "mixed", "c", (F.col("first.from") + F.col("any_to") - F.col("any_from")).alias("end")))
    # Kinds of one anchor have runs in common, or none: those of each kind's first place are compared.
    chosen = kept(kind.filter("mixed").groupBy(F.col("first.d").alias("d"), F.col("first.t").alias("t"))
                          .agg(F.collect_list(F.struct(F.col("first.from").alias("from"), F.col("end").alias("to"))).alias("at")))
    once = whole.join(small_side(chosen, 256), ["d", "t"]).dropDuplicates(["d", "t"]).select("d", "t", "text", "at")
    runs = kept(_runs(once), chosen)
    low = runs.groupBy("a", "b").agg(F.min(place).alias("low"), F.count("*").alias("n")).filter("n > 1").select("a", "b", "low")
    runs = kept(runs.join(low, ["a", "b"], "left").select("d", "t", "stretch", "from", F.coalesce("low", place).alias("low")), runs)
    keeps = runs.groupBy("d", "t", F.col("stretch").alias("from")).agg(F.collect_set("low.d").alias("kept")).select(place.alias("first"), "kept")
    several = kept(kind.filter("c > 1").join(keeps, "first", "left")
                           .select("g", "s", "first", F.coalesce("kept", F.array("first.d")).alias("kept")), kind)
    copies = found.join(several, ["g", "s"]).filter(place != F.col("first"))
    single = runs.withColumn("to", F.col("from") + SPAN_WORDS).filter(place != F.col("low"))
    return copies.select(*_later("d", "t", "from", "to", "first"), "kept").union(
        single.select(*_later("d", "t", "from", "to", "low"), F.array("low.d").alias("kept")))


def removals(docs: DataFrame) -> DataFrame:
    """``d, t`` (the document), ``spans`` (sorted, ``[from, to)`` in words) and ``kept_in`` (ids of the documents that keep them)."""
    whole = docs.filter(F.col("text").isNotNull()).select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("d"), F.xxhash64("text").alias("t"), "text")
    classes = kept(_paragraphs(whole, "bands").groupBy("cls").agg(F.first("bands").alias("bands"), F.first("sketch").alias("sketch")))

    def texts_of(needed: DataFrame) -> DataFrame:
        return (_paragraphs(whole, "texts").join(needed, "cls", "left_semi").groupBy("cls").agg(F.first("text").alias("text")))

    linked = link(classes, texts_of, JACCARD, SHINGLE)
    number = lambda c, at: F.conv(F.hex(F.substring(c, at, 8)), 16, -10).cast("long")
    same = kept(linked.filter("cls <> comp").select(number("cls", 1).alias("a"), number("cls", 9).alias("b"), number("comp", 1).alias("ca"), number("comp", 9).alias("cb")), linked, classes)
    # Equal lines are equal runs: only components of several lines are left.
    several = kept(same.union(same.select(F.col("ca").alias("a"), F.col("cb").alias("b"), "ca", "cb").distinct()), same)
    found = kept(_paragraphs(whole, "members").join(small_side(several, 40), ["a", "b"]).select("d", "t", "from", "to", "ca", "cb"), several)
    place = F.struct("d", "t", "from")
    first = found.groupBy("ca", "cb").agg(F.min(place).alias("first"))
    lines = found.join(first, ["ca", "cb"]).filter(place != F.col("first")).select("d", "t", "from", "to", F.array("first.d").alias("kept"))
    later = lines.union(_repeated(whole))
    # Merge what overlaps or touches.
    order = Window.partitionBy("d", "t").orderBy("from", "to")
    reach = F.max("to").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = later.withColumn("new", F.coalesce((F.col("from") > reach).cast("int"), F.lit(1)))
    merged = (marked.withColumn("no", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))).groupBy("d", "t", "no")
              .agg(F.min("from").alias("from"), F.max("to").alias("to"), F.collect_set("kept").alias("kept"))
              .filter(F.col("to") - F.col("from") >= SPAN_WORDS))
    return merged.groupBy("d", "t").agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias("spans"),
                                        F.array_sort(F.array_distinct(F.flatten(F.flatten(F.collect_list("kept"))))).alias("kept_in"))


def op4_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """One row for each document: words removed, the stretches, and the documents that keep them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    cut = kept(removals(docs))
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(_NO_ID)).alias("d"), F.xxhash64("text").alias("t"))
    words_cut = F.aggregate("spans", F.lit(0), lambda n, x: n + x["to"] - x["from"])
    return rows.join(small_side(cut, 128), ["d", "t"], "left").select(
        "doc_id", F.coalesce(words_cut, F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(F.transform("spans", lambda x: F.concat_ws("-", x["from"].cast("string"), x["to"].cast("string"))), ","), F.lit("")).alias("spans"),
        F.coalesce(F.array_join(F.transform("kept_in", lambda x: x.cast("string")), ","), F.lit("")).alias("kept_in"),
        F.col("spans").isNotNull().alias("repeated"))
