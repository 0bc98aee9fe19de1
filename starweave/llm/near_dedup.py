"""MinHash near-dedup (10): circulant MinHash, banding, exact Jaccard, components.

Circulant MinHash needs two permutations for all coordinates: sigma scatters the
shingles over a ring of 2**32 places, and coordinate ``k`` is the smallest value
of pi, circularly shifted by ``k``, over the scattered set.

Defined results: a NULL or blank text has no shingles and is linked with
nothing; a text of fewer than five words is one shingle; equal texts are one
class, whatever their number; repeated rows share one component; a NULL
``doc_id`` never names a component unless no other id is there; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ._cluster import kept, small_side
from ._linking import link
from ._tokens import NOT_SPACE, chunks, mix, shingles, words

SHINGLE = 5
JACCARD = 0.75
#: 40 bands of 5 rows: a pair at the threshold is missed once in 50,000 times.
BANDS, ROWS = 40, 5
#: Coordinates whose lowest byte is kept to estimate the similarity of a pair.
SKETCH = 128


def _pi(x: np.ndarray) -> None:
    """A permutation of the 32-bit ring, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)


def signatures(g: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """One row of ``size`` circulant MinHash coordinates for each non-empty set ``g[at[i]:at[i+1]]``."""
    sigma = (g >> np.uint64(32)).astype(np.uint32)
    begins = at[:-1][at[:-1] < at[1:]]
    out = np.empty((len(begins), size), np.uint32)
    x = np.empty_like(sigma)
    for k in range(size):
        np.add(sigma, np.uint32(k), out=x)  # the circular shift
        _pi(x)
        out[:, k] = np.minimum.reduceat(x, begins)
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band of each row; bands never meet each other."""
    keys = np.zeros((len(sig), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
    parts = sig[:, : bands * rows].reshape(len(sig), bands, rows)
    for r in range(rows):
        keys = mix(keys ^ parts[:, :, r])
    return keys.view(np.int64)


def describe(frame: DataFrame, keys: str, shingle: int, bands: int, rows: int) -> DataFrame:
    """``frame(<keys>, cls, text)`` as ``(<keys>, cls, n_shingles, bands, sketch)``; a whole text at a time."""
    names = [c for c in frame.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, off in chunks(batch.column("text")):
                h, first, *_ = words(buf, off, NOT_SPACE)
                g, at = shingles(h, first, shingle)
                n = [len(np.unique(g[at[i]: at[i + 1]])) for i in range(hi - lo)]
                have = np.flatnonzero(at[:-1] < at[1:])
                sig = signatures(g, at, bands * rows) if len(have) else np.zeros((0, bands * rows), np.uint32)
                key, sketch = band_keys(sig, bands, rows), (sig[:, :SKETCH] & np.uint32(255)).astype(np.uint8)
                ends = np.zeros(hi - lo + 1, np.int32)
                ends[1:][have] = bands
                np.cumsum(ends, out=ends)
                of = dict(zip(have.tolist(), range(len(have)), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(lo, hi - lo) for c in names]
                    + [pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(key.ravel())),
                       pa.array([sketch[of[i]].tobytes() if i in of else b"" for i in range(hi - lo)], pa.binary())],
                    [*names, "n_shingles", "bands", "sketch"])

    return frame.mapInArrow(run, f"{keys}, cls binary, n_shingles bigint, bands array<bigint>, sketch binary")


def _groups(docs: DataFrame, jaccard: float, shingle: int, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """``items(doc_id, cls, n_shingles, ..)``, a row for each document, and ``named(cls, component_id, keeper)``.

    ``named`` has the classes of several rows, and those that are not the keeper
    of their component: the class with the smallest id (NULL last), then the
    smallest digest. A class that is not there has its own id and keeps its row.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    docs = docs.withColumn("cls", F.unhex(F.md5("text")))
    items = kept(describe(docs.select("doc_id", "cls", "text"), "doc_id bigint", shingle, bands, rows))
    classes = kept(items.filter("n_shingles > 0").groupBy("cls")
                   .agg(F.min("doc_id").alias("low"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")))

    def texts_of(needed: DataFrame) -> DataFrame:
        return (docs.select("cls", "text").join(needed, "cls", "left_semi")
                .groupBy("cls").agg(F.first("text").alias("text")))

    linked = link(classes.select("cls", "bands", "sketch"), texts_of, jaccard, shingle)
    low = classes.select("cls", "low").join(linked, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    first = low.groupBy("comp").agg(F.min(F.struct(F.col("low").isNull(), "low", "cls")).alias("first"))
    named = kept(low.join(first, "comp").join(_several(items), "cls", "left").filter("cls <> first.cls OR several OR low IS NULL")
                 .select("cls", F.col("first.low").alias("component_id"), F.col("first.cls").alias("keeper")), linked, classes)
    return items, named


def near_duplicates(docs: DataFrame, jaccard: float = JACCARD, shingle: int = SHINGLE,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, text_md5`` for each row of ``docs(doc_id, text)``."""
    items, named = _groups(docs, jaccard, shingle, bands, rows)
    out = items.select("doc_id", "n_shingles", "cls").join(small_side(named.select("cls", "component_id"), 48), "cls", "left")
    own = F.coalesce(F.col("component_id"), F.col("doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"),
                      F.lower(F.hex("cls")).alias("text_md5"))


def _several(items: DataFrame) -> DataFrame:
    """Classes of more than one row."""
    return items.filter("n_shingles > 0").groupBy("cls").agg((F.count("*") > 1).alias("several"))


def op10_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component, one row stays.

    It has the smallest id (a NULL id only where there is no other), then the
    smallest digest of its text; of rows that share both, any one. Rows without
    shingles belong to no component, and all stay. The rows of the other classes
    go before anything is shuffled, as do copies with a greater id.
    """
    _, named = _groups(docs, JACCARD, SHINGLE, BANDS, ROWS)
    named = named.select(F.lower(F.hex("cls")).alias("m"), "component_id", (F.col("cls") == F.col("keeper")).alias("keeps"))
    whole = docs.select(F.struct("*").alias("row"), F.md5(F.coalesce("text", F.lit(""))).alias("m"))
    marked = whole.join(small_side(named, 96), "m", "left")
    alone = marked.filter("keeps IS NULL").select("row.*")
    once = (marked.filter(F.col("keeps") & F.col("row.doc_id").cast("long").eqNullSafe(F.col("component_id")))
            .groupBy("m").agg(F.first("row").alias("row")).select("row.*"))
    return alone.union(once)
