"""Links between classes of texts that share a MinHash band, and their components.

Nodes are classes of equal texts (``cls``, the MD5 digest), so copies never
become pairs. No step lists all pairs of a bucket:

1. In rounds, each class is compared with a few hubs: members that come first in
   the round's order of a bucket, taken where the two meet in the most bands.
   Exact verification, then components. Large groups of near copies collapse
   here.
2. Buckets that still hold several components are searched for links across
   components only: a pair inside a component would change nothing. In a bucket
   of a few members the signatures are compared, and each pair that they allow is
   verified once, however many buckets it shares; larger buckets are searched in
   blocks of texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ._cluster import dropped, kept, small_side
from ._tokens import NOT_SPACE, chunks, shingles, words

#: Bytes of text that one block of a bucket holds, about.
BLOCK_BYTES = 4 << 20
#: Members of a bucket whose pairs are listed, at most: no more than half as many pairs for each member.
FEW_MEMBERS = 16
#: Pairs whose signatures are compared at once.
PAIRS = 1 << 18
#: Rounds of hubs, and hubs that a class tries in each.
ROUNDS, TRIES = 2, 6
#: Standard deviations below the threshold at which a signature still passes.
SIGMAS = 5.0


def components(edges: DataFrame) -> DataFrame:
    """``(node, comp)`` for every node of ``edges(a, b)``: the smallest node reachable.

    Alternates the large-star and the small-star step until nothing changes.
    Every step is an aggregate and a join, so the links of one hub are spread
    over tasks; every round is kept in the shared folder in place of the last one.
    """
    edges = kept(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        edges_large = (both.join(low, "a").filter("b > a").select(F.col("m").alias("a"), "b")
                       .filter("a <> b").distinct())
        # Small star: every node's smaller neighbours, and itself, hang from the smallest of them.
        low = edges_large.groupBy("b").agg(F.min("a").alias("m"))
        hung = edges_large.join(low, "b")
        edges_new = (hung.select(F.col("m").alias("a"), "b")
                     .union(hung.filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b")))
                     .distinct())
        edges = kept(edges_new, edges)
        # Equal edge sets have equal counts and sums of hashes; smaller parents change the sum.
        new = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == (new["n"], new["h"]):
            break
        state = (new["n"], new["h"])
    # Now every edge leads to a smallest node.
    return kept(edges.select(F.col("b").alias("node"), F.col("a").alias("comp"))
                .union(edges.select(F.col("a").alias("node"), F.col("a").alias("comp"))).distinct(), edges)


def verified(pairs: DataFrame, texts: DataFrame, jaccard: float, k: int) -> DataFrame:
    """The ``pairs(a, b)`` whose texts' sets of ``k``-word shingles have the exact Jaccard or more.

    ``texts(cls, text)`` has one row for each class. The threshold is compared
    in integers: ``1000 * intersection >= 1000 * jaccard * union``.
    """
    per_mille = round(jaccard * 1000)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = []
            for name in ("ta", "tb"):
                own = []
                for lo, hi, buf, off in chunks(batch.column(name)):
                    h, first, *_ = words(buf, off, NOT_SPACE)
                    g, at = shingles(h, first, k)
                    own += [np.unique(g[at[i]: at[i + 1]]) for i in range(hi - lo)]
                sets.append(own)
            good = []
            for x, y in zip(*sets, strict=True):
                small, large = min(len(x), len(y)), max(len(x), len(y))
                if 1000 * small < per_mille * large:
                    good.append(False)
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(both > 0 and 1000 * both >= per_mille * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    a = texts.select(F.col("cls").alias("a"), F.col("text").alias("ta"))
    b = texts.select(F.col("cls").alias("b"), F.col("text").alias("tb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb").mapInArrow(check, "a binary, b binary")


def _lift(edges: DataFrame, comp: DataFrame) -> DataFrame:
    """Edges between classes as edges between their components of ``comp(cls, comp)``."""
    return (edges.join(comp.select(F.col("cls").alias("a"), F.col("comp").alias("ca")), "a", "left")
            .join(comp.select(F.col("cls").alias("b"), F.col("comp").alias("cb")), "b", "left")
            .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))


def _join_components(comp: DataFrame, edges: DataFrame) -> DataFrame:
    """``comp(cls, comp)`` after linking the components that ``edges(a, b)`` connect; takes the place of both."""
    merged = components(_lift(edges, comp))
    return kept(comp.join(merged.withColumnRenamed("comp", "upper"), comp["comp"] == merged["node"], "left")
                .select("cls", F.coalesce("upper", "comp").alias("comp")), merged, comp, edges)


def _mixed(before: DataFrame, comp: DataFrame) -> DataFrame:
    """The rows ``band, cls, comp`` of buckets that hold several components; they did so ``before``."""
    owned = before.select("band", "cls").join(comp, "cls")
    several = owned.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("band")
    return kept(owned.join(several, "band"), before)


def _least(jaccard: float, size: int) -> float:
    """Equal coordinates of two signatures of ``size`` that allow the threshold."""
    return (jaccard - SIGMAS * np.sqrt(jaccard * (1 - jaccard) / size)) * size


def _allowed(buckets: DataFrame, jaccard: float) -> DataFrame:
    """``(a, b)``: pairs of the members ``m(cls, comp, sketch)`` of each bucket that lie in two components
    and whose signatures allow the threshold; each pair once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("m")
            edge = column.offsets.to_numpy().astype(np.int64)
            members = column.values.slice(edge[0], edge[-1] - edge[0])
            edge -= edge[0]
            if not len(members):
                continue
            cls, comp, sketch = (members.field(n) for n in range(3))
            comp = comp.dictionary_encode().indices.to_numpy()
            sketch = np.frombuffer(b"".join(sketch.to_pylist()), np.uint8).reshape(len(members), -1)
            least = _least(jaccard, sketch.shape[1])
            n = np.repeat(edge[1:], np.diff(edge)) - np.arange(len(members)) - 1  # members behind each in its bucket
            done = np.cumsum(n)
            lo = 0
            while lo < len(members):
                hi = max(lo + 1, int(np.searchsorted(done, done[lo] - n[lo] + PAIRS, side="right")))
                x = np.repeat(np.arange(lo, hi), n[lo:hi])
                y = x + 1 + np.arange(len(x)) - np.repeat(done[lo:hi] - n[lo:hi] - (done[lo] - n[lo]), n[lo:hi])
                apart = comp[x] != comp[y]
                x, y = x[apart], y[apart]
                near = (sketch[x] == sketch[y]).sum(axis=1) >= least
                yield pa.RecordBatch.from_arrays([cls.take(pa.array(x[near])), cls.take(pa.array(y[near]))], ["a", "b"])
                lo = hi

    found = buckets.mapInArrow(run, "a binary, b binary")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _across(mixed: DataFrame, sketches: DataFrame, texts: DataFrame, jaccard: float, k: int) -> DataFrame:
    """Links between members of a bucket that lie in two components.

    Nearly all buckets have few members: only the pairs that their signatures allow are sent
    their texts. The others are searched in blocks of ``BLOCK_BYTES`` of text against blocks.
    Pairs whose signatures allow the threshold are verified there on the spot, on
    whole texts; only links leave the task, never candidates.
    """
    crowds = mixed.groupBy("band").agg(F.count("*").alias("n"))
    few = (mixed.join(crowds.filter(F.col("n") <= FEW_MEMBERS).select("band"), "band").join(sketches, "cls")
           .groupBy("band").agg(F.collect_list(F.struct("cls", "comp", "sketch")).alias("m")))
    found = verified(_allowed(few.select("m"), jaccard), texts, jaccard, k)
    many = mixed.join(crowds.filter(F.col("n") > FEW_MEMBERS).select("band"), "band")
    return found.union(_across_blocks(many, sketches, texts, jaccard, k)).distinct()


def _across_blocks(mixed: DataFrame, sketches: DataFrame, texts: DataFrame, jaccard: float, k: int) -> DataFrame:
    """``_across`` for buckets of any size."""
    sized = mixed.join(texts.select("cls", F.octet_length("text").alias("size")), "cls")
    blocks = sized.groupBy("band").agg(F.expr(f"CAST(ceil((sum(size) + 1) / {BLOCK_BYTES}) AS INT)").alias("blocks"))
    member = (mixed.join(blocks, "band").join(sketches, "cls").join(texts, "cls")
              .withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))))
    member = member.select("band", "cls", "comp", "sketch", "text", "own",
                           F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    per_mille = round(jaccard * 1000)

    def search(table: pa.Table) -> pa.Table:
        sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(table.num_rows, -1)
        cls = table["cls"].to_pylist()
        numbers: dict[bytes, int] = {}
        comp = np.array([numbers.setdefault(c, len(numbers)) for c in table["comp"].to_pylist()])
        i, j, own = table["i"][0].as_py(), table["j"][0].as_py(), table["own"].to_numpy()
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        least = _least(jaccard, sketch.shape[1])
        sets = []
        for lo, hi, buf, off in chunks(table["text"]):
            h, first, *_ = words(buf, off, NOT_SPACE)
            g, at = shingles(h, first, k)
            sets += [np.unique(g[at[n]: at[n + 1]]) for n in range(hi - lo)]
        size = np.array([len(x) for x in sets])
        ptr = np.concatenate([[0], np.cumsum(size)])
        _, flat = np.unique(np.concatenate(sets), return_inverse=True)  # shingles by number
        held = np.zeros(flat.max(initial=-1) + 2, bool)
        out = []
        for x in left.tolist():
            y = right[right > x] if i == j else right  # inside one block, each pair once
            y = y[comp[y] != comp[x]]
            y = y[(sketch[y] == sketch[x]).sum(axis=1) >= least]
            if not len(y):
                continue
            mine = flat[ptr[x]: ptr[x + 1]]
            held[mine] = True
            begin = np.cumsum(size[y]) - size[y]
            both = np.add.reduceat(held[flat[np.repeat(ptr[y] - begin, size[y]) + np.arange(size[y].sum())]].astype(np.int64), begin)
            held[mine] = False
            out += [(cls[x], cls[z]) for z in y[1000 * both >= per_mille * (size[x] + size[y] - both)].tolist()]
        return pa.table({"a": pa.array([a for a, _ in out], pa.binary()), "b": pa.array([b for _, b in out], pa.binary())})

    return member.groupBy("band", "i", "j").applyInArrow(search, "a binary, b binary").distinct()


def link(classes: DataFrame, texts_of: Callable[[DataFrame], DataFrame], jaccard: float, k: int) -> DataFrame:
    """``(cls, comp)`` of every class that shares a bucket with another one.

    ``classes(cls binary, bands array<bigint>, sketch binary)``: one row for
    each distinct text, its bands distinct, kept. ``texts_of(needed)`` gives ``(cls,
    text)`` of the classes in ``needed(cls)``.
    """
    rows = classes.select("cls", F.explode("bands").alias("band"))
    buckets = rows.groupBy("band").agg(F.count("*").alias("c")).filter("c > 1")  # a class is in a bucket once
    shared = kept(rows.join(buckets.select("band"), "band"))
    needed = kept(shared.select("cls").distinct())
    texts = kept(texts_of(small_side(needed, 48)))
    comp = kept(needed.select("cls", F.col("cls").alias("comp")), needed)
    # What a group's copies were made from meets more of them than they meet each other: the best hub.
    crowd = shared.groupBy("band").agg(F.count("*").alias("c"))
    degree = kept(shared.join(crowd, "band").groupBy("cls").agg(F.sum("c").alias("degree")))
    mixed = kept(shared.select("band", "cls", F.col("cls").alias("comp")), shared)
    for n in range(ROUNDS):
        rank = F.struct(("degree" if n == 0 else F.pmod(F.xxhash64(F.lit(n), "cls"), F.lit(1 << 40)) * F.log("degree")), "cls", "comp")
        hubs = mixed.join(degree, "cls").groupBy("band").agg(F.max(rank).alias("hub"))
        met = (mixed.join(hubs, "band").filter("comp <> hub.comp").groupBy("cls", F.col("hub.cls").alias("hub")).agg(F.count("*").alias("n")))
        star = (met.groupBy("cls").agg(F.slice(F.sort_array(F.collect_list(F.struct("n", "hub")), False), 1, TRIES).alias("try"))
                .select("cls", F.explode("try.hub").alias("hub")))
        pairs = star.select(F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b")).distinct()
        found = kept(verified(pairs, texts, jaccard, k))
        comp = _join_components(comp, found)
        mixed = _mixed(mixed, comp)  # components only grow: a bucket of one stays so
    dropped(degree)
    rest = kept(_across(mixed, classes.select("cls", "sketch"), texts, jaccard, k), mixed, texts)
    return _join_components(comp, rest)
