"""Conversation prefix trie (11): whole-sequence collapse and weighted prefixes.

A conversation is rebuilt from the first turns of another one and the rest of
its own. Identical rebuilt conversations collapse into one weighted sequence
with the list of the conversations that end there; a sequence that is a proper
prefix of another one drops out by anti-join, the others are the trie's leaves;
the prefixes of the sequences, with their weights, aggregate into the nodes.

* **Identity.** A turn is the MD5 of role and text. The name of a prefix is the
  sum, over its turns, of a 2 x 64 bit hash of (place, turn), each half of 32 bits
  summed modulo 2**32, and its depth. Sums need no walk along a conversation, so a
  conversation of any length is cut into parts whose sums are added up. Two
  prefixes of one depth share a name by chance once in 2**128.
* **Subtrees without recursion.** The representative of a node is its smallest
  conversation. Along a sequence, the nodes that it represents are a tail: from
  some depth on, all of them. With ``T(s)`` the cost of all nodes that ``s``
  represents, a node's subtree costs the rest of its representative's tail from
  it on, and ``T(s)`` of every other sequence through it: one aggregate.
* **Skew.** Turns are dealt by ranges of (conversation, turn), and later joins and
  windows use (conversation, part), so one long conversation is spread. Common
  prefixes are only ever aggregated; a node's many children find it by a
  broadcast of at most ``HOT_PARENTS`` rows. End lists are kept in blocks of ids.

Only names, places and lengths are shuffled; a turn's text is read once.

Defined results: rows without ``conv_id`` belong to no conversation; a NULL role
or text is empty; a NULL turn is first; turns of one number stand in the order of
the MD5 of role and text, and repeated rows are turns each; ``%`` keeps the sign,
as in SQL; extra columns are ignored; an empty table has no node, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ._cluster import Stages

#: Conversations of a hundred share the first turns of one; up to 5 of them.
GROUP, HEADS = 100, 6
#: Nodes with so many children that those are dealt with by broadcast: never more of them than this.
HOT_PARENTS = 10_000
#: Conversation ids of one block of an end list, at most (a power of two, as its exponent).
END_BLOCK_BITS = 12

_LOW = 0xFFFFFFFF
_KEY = ["depth", "k1", "k2"]
_LANES = ["a1", "a2", "a3", "a4"]


def turn_digest(role: Column, text: Column) -> Column:
    """16 bytes that stand for a turn; a NULL is empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))


def _lanes(depth: Column, digest: Column) -> list[Column]:
    x, y = (F.xxhash64(F.lit(seed), depth.cast("long"), digest) for seed in (1, 2))
    return [v.alias(n) for n, v in zip(_LANES, (x.bitwiseAND(_LOW), F.shiftrightunsigned(x, 32), y.bitwiseAND(_LOW), F.shiftrightunsigned(y, 32)), strict=True)]


def _name(lanes: list[Column], names: tuple[str, str]) -> list[Column]:
    """Two 64-bit numbers from four sums, each modulo 2**32."""
    fold = lambda a, b: F.shiftleft(a.bitwiseAND(_LOW), 32).bitwiseOR(b.bitwiseAND(_LOW))
    return [fold(lanes[0], lanes[1]).alias(names[0]), fold(lanes[2], lanes[3]).alias(names[1])]


def _before(value: str, key: str, order: Column) -> Column:
    """The sum of ``value`` over the rows of ``key`` that stand before this one."""
    return F.coalesce(F.sum(value).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


@dataclass
class Rebuilt:
    """``turns(conv_id, part, depth, digest, chars)`` and ``convs(conv_id, length)``; turnless conversations only in the latter."""

    turns: DataFrame
    convs: DataFrame


def rebuild(conversations: DataFrame, stages: Stages, group: int = GROUP, heads: int = HEADS) -> Rebuilt:
    """Conversation c: the first h turns of c - c % group, then its own after the first h; h = crc32(c) % heads."""
    text = F.coalesce(F.col("text"), F.lit(""))
    raw = stages.keep(conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), turn_digest(F.col("role"), F.col("text")).alias("digest"),
        F.length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("n")), "raw")
    # A range of (conversation, turn) is a part, however many turns a conversation has.
    dealt = stages.keep(raw.repartitionByRange("conv_id", "turn", "digest", "n").withColumn("part", F.spark_partition_id()), "dealt", ("raw",))
    sizes = dealt.groupBy("conv_id", "part").agg(F.count("*").alias("rows"))
    sizes = sizes.withColumn("before", _before("rows", "conv_id", F.col("part")))
    own = (sizes.groupBy("conv_id").agg(F.sum("rows").alias("own")).withColumn("base", F.col("conv_id") - F.col("conv_id") % group)
           .withColumn("h", F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(heads))))
    convs = own.join(own.select(F.col("conv_id").alias("base"), F.col("own").alias("there")), "base", "left")
    taken = F.least("h", F.coalesce("there", F.lit(0)))
    convs = stages.keep(convs.select("conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")), "convs")
    parts = stages.keep(sizes.join(convs.select("conv_id", "h", "taken"), "conv_id").select("conv_id", "part", "before", "h", "taken"), "parts")
    place = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(F.asc_nulls_first("turn"), "digest", "n"))
    ranked = dealt.withColumn("place", place).join(parts, ["conv_id", "part"]).withColumn("place", F.col("before") + F.col("place"))
    first = (dealt.filter(F.col("conv_id") % group == 0).withColumn("place", place).join(parts, ["conv_id", "part"])
             .select(F.col("conv_id").alias("base"), (F.col("before") + F.col("place")).alias("depth"), "digest", "chars").filter(F.col("depth") < heads))
    lent = convs.join(first, "base").filter("depth <= h").select("conv_id", F.lit(-1).alias("part"), "depth", "digest", "chars")
    kept = ranked.filter("place > h").select("conv_id", "part", (F.col("taken") + F.col("place") - F.col("h")).alias("depth"), "digest", "chars")
    turns = stages.keep(lent.unionByName(kept), "turns", ("dealt", "parts"))
    return Rebuilt(turns, convs.select("conv_id", "length"))


@dataclass
class Trie:
    """``nodes``: one row a node, ``turn_md5`` naming its last turn; ``ends``: ``node keys, block, ids`` of the conversations that end at a node."""

    nodes: DataFrame
    ends: DataFrame

    def with_turns(self, conversations: DataFrame) -> DataFrame:
        """``nodes`` with the ``role`` and ``text`` of each node's last turn (NULL at the root)."""
        said = (conversations.select(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
                                     F.lower(F.hex(turn_digest(F.col("role"), F.col("text")))).alias("turn_md5")))
        once = said.groupBy("turn_md5").agg(F.first("role").alias("role"), F.first("text").alias("text"))
        return self.nodes.join(once, "turn_md5", "left")


def _ends_sha256(ends: DataFrame) -> DataFrame:
    """``depth, k1, k2, ends_sha256`` of the end lists ``ends(depth, k1, k2, block, ids)``.

    A list of several blocks is hashed block by block, in order: memory holds one
    block, and the task that hashes it reads as many rows as the list has blocks.
    """
    text = ends.select(*_KEY, "block", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("text"))
    lists = text.groupBy(*_KEY).agg(F.count("*").alias("blocks"), F.first("text").alias("text"))
    short = lists.filter("blocks = 1").select(*_KEY, F.sha2("text", 256).alias("ends_sha256"))
    long = text.join(lists.filter("blocks > 1").select(*_KEY), _KEY, "left_semi").repartition(*_KEY).sortWithinPartitions(*_KEY, "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        row = lambda: pa.RecordBatch.from_pydict({n: [v] for n, v in zip([*_KEY, "ends_sha256"], [*key, state.hexdigest()], strict=True)})
        for batch in batches:
            for *now, _, ids in zip(*[batch.column(c).to_pylist() for c in [*_KEY, "block", "text"]], strict=True):
                if now != key:
                    if key:
                        yield row()
                    key, state = now, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
        if key:
            yield row()

    return short.union(long.mapInArrow(run, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string"))


def _parent_ids(tops: DataFrame, nodes: DataFrame) -> DataFrame:
    """``depth, k1, k2, parent_conv_id`` of the nodes in ``tops``, whose parents have other representatives."""
    up = tops.withColumns({"pd": F.col("depth") - 1})
    crowd = up.groupBy("pd", "p1", "p2").agg(F.count("*").alias("c"))
    named = crowd.join(nodes.select(F.col("depth").alias("pd"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id")), ["pd", "p1", "p2"])
    # Fewer than HOT_PARENTS nodes can have this share of all children.
    share = tops.count() // HOT_PARENTS + 1
    hot = F.broadcast(named.filter(F.col("c") > max(share, 100)).drop("c"))
    cold = up.join(hot, ["pd", "p1", "p2"], "left_anti").join(named.drop("c"), ["pd", "p1", "p2"])
    return up.join(hot, ["pd", "p1", "p2"]).unionByName(cold).select(*_KEY, "parent_conv_id")


def prefix_trie(conversations: DataFrame, group: int = GROUP, heads: int = HEADS) -> Trie:
    """The trie of all rebuilt conversations of ``conversations(conv_id, turn, role, text)``."""
    stages = Stages(conversations.sparkSession, "prefix-trie")
    rebuilt = rebuild(conversations, stages, group, heads)
    lanes = _lanes(F.col("depth"), F.col("digest"))
    # Whole sequences: a conversation's name is the sum over its parts.
    parts = stages.keep(rebuilt.turns.select("conv_id", "part", *lanes).groupBy("conv_id", "part").agg(*[F.sum(a).alias(a) for a in _LANES]), "sums")
    whole = rebuilt.convs.join(parts.groupBy("conv_id").agg(*[F.sum(a).alias(a) for a in _LANES]), "conv_id", "left")
    whole = stages.keep(whole.select("conv_id", F.col("length").alias("depth"), *_name([F.coalesce(a, F.lit(0)) for a in _LANES], ("k1", "k2"))), "whole")
    seqs = stages.keep(whole.groupBy(*_KEY).agg(F.count("*").alias("weight"), F.min("conv_id").alias("conv_id")), "sequences")
    ends = stages.keep(whole.groupBy(*_KEY, F.shiftright("conv_id", END_BLOCK_BITS).alias("block"))
                       .agg(F.array_sort(F.collect_list("conv_id")).alias("ids")), "ends", ("whole", "convs"))  # ids are distinct: a block is bounded
    # Prefixes of one representative of each sequence, with its weight.
    starts = parts.select("conv_id", "part", *[_before(a, "conv_id", F.col("part")).alias(f"{a}_before") for a in _LANES])
    starts = starts.join(seqs.select("conv_id", "weight", F.col("depth").alias("length")), "conv_id")
    upto = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = (rebuilt.turns.select("*", *lanes).join(starts, ["conv_id", "part"])
            .withColumns({f"{a}_upto": F.col(f"{a}_before") + F.sum(a).over(upto) for a in _LANES}))
    key = _name([F.col(f"{a}_upto") for a in _LANES], ("k1", "k2"))
    parent = _name([F.col(f"{a}_upto") - F.col(a) for a in _LANES], ("p1", "p2"))
    root = seqs.select("conv_id", F.lit(-2).alias("part"), F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(k) for k in ("k1", "k2", "p1", "p2")],
                       F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("chars"), "weight", F.col("depth").alias("length"))
    prefixes = stages.keep(rows.select("conv_id", "part", "depth", *key, *parent, "digest", "chars", "weight", "length").unionByName(root), "prefixes", ("turns", "sums"))
    nodes = prefixes.groupBy(*_KEY).agg(
        F.sum("weight").alias("n_convs"), F.min(F.struct("conv_id", "part", "length")).alias("rep"), F.max("chars").alias("chars"), F.max("digest").alias("digest"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.bool_or(F.col("length") > F.col("depth")).alias("longer"))
    nodes = stages.keep(nodes.select(*_KEY, "p1", "p2", "n_convs", "rep.*", "digest", "longer", ((F.col("n_convs") - 1) * F.col("chars")).alias("cost")), "named")
    # Leaves: sequences that are no proper prefix of another one.
    leaves = seqs.join(nodes.filter("longer").select(*_KEY), _KEY, "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    # What each representative's tail costs, by part: its rest from the part's end on, its whole, its first depth.
    tails = nodes.groupBy("conv_id", "part").agg(F.sum("cost").alias("cost"), F.min("depth").alias("top"))
    tails = tails.select("conv_id", "part", _before("cost", "conv_id", F.desc("part")).alias("rest"),
                         F.sum("cost").over(Window.partitionBy("conv_id")).alias("tail"), F.min("top").over(Window.partitionBy("conv_id")).alias("top"))
    tails = stages.keep(tails, "tails")
    totals = (tails.select("conv_id", "tail").distinct().join(leaves, "conv_id", "full")
              .select("conv_id", F.coalesce("tail", F.lit(0)).alias("tail"), F.coalesce("leaf", F.lit(0)).alias("leaf")))
    through = prefixes.select("conv_id", "part").distinct().join(totals, "conv_id")
    through = (prefixes.select("conv_id", "part", *_KEY).join(through, ["conv_id", "part"])
               .groupBy(*_KEY).agg(F.sum("leaf").alias("n_leaves"), F.sum("tail").alias("tails")))
    through = stages.keep(through, "through", ("prefixes",))
    down = Window.partitionBy("conv_id", "part").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    nodes = stages.keep(nodes.withColumn("below", F.sum("cost").over(down)).join(tails, ["conv_id", "part"])
                        .select(*_KEY, "p1", "p2", "conv_id", "n_convs", "digest", "length", (F.col("below") + F.col("rest") - F.col("tail")).alias("own"),
                                ((F.col("depth") == F.col("top")) & (F.col("depth") > 0)).alias("is_top")), "measured", ("named", "tails"))
    tops = nodes.filter("is_top").select(*_KEY, "p1", "p2")
    children = tops.groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("others"))
    out = (nodes.join(through, _KEY).join(children, _KEY, "left").join(_parent_ids(tops, nodes), _KEY, "left").join(_ends_sha256(ends), _KEY, "left"))
    out = out.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id")).alias("parent_conv_id"), "n_convs",
        (F.coalesce("others", F.lit(0)) + (F.col("length") > F.col("depth")).cast("long")).alias("n_children"), "n_leaves",
        (F.col("own") + F.col("tails")).alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        F.lower(F.hex("digest")).alias("turn_md5"), "k1", "k2")
    return Trie(out, ends)


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    trie = prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return trie.nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


ORACLE_SQL = f"""
WITH poly AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
              FROM (SELECT unnest(range(256)) AS i)),
own AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS r
        FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, c - c % {GROUP} AS b, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                                                          lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) % {HEADS} AS h
          FROM (SELECT DISTINCT c FROM own), poly),
turns AS (SELECT convs.c, 0 AS phase, r, role, text FROM convs JOIN own ON own.c = b AND r <= h
          UNION ALL SELECT convs.c, 1, r, role, text FROM convs JOIN own ON own.c = convs.c AND r > h),
whole AS (SELECT convs.c, coalesce(list({{'r': role, 't': text}} ORDER BY phase, r) FILTER (WHERE role IS NOT NULL), []) AS s FROM convs LEFT JOIN turns USING (c) GROUP BY convs.c),
member AS (SELECT c, s, unnest(range(len(s) + 1)) AS d FROM whole),
node AS (SELECT s[1:d] AS p, d, min(c) AS conv_id, count(*) AS n, bool_or(len(s) > d) AS longer,
                coalesce(string_agg(c, ',' ORDER BY c) FILTER (WHERE len(s) = d), '') AS ends
         FROM member GROUP BY s[1:d], d),
child AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n FROM node WHERE d > 0 GROUP BY p[1:d - 1], d - 1),
subtree AS (SELECT a.p, a.d, count(*) FILTER (WHERE NOT b.longer) AS leaves, sum(CASE WHEN b.d > 0 THEN (b.n - 1) * length(b.p[b.d]['t']) ELSE 0 END) AS saved
            FROM node a JOIN node b ON b.d >= a.d AND b.p[1:a.d] = a.p GROUP BY a.p, a.d)
SELECT node.conv_id, node.d AS depth, up.conv_id AS parent_conv_id, node.n AS n_convs, CAST(coalesce(child.n, 0) AS BIGINT) AS n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(node.ends) AS ends_sha256
FROM node JOIN subtree ON subtree.p = node.p AND subtree.d = node.d
LEFT JOIN child ON child.p = node.p AND child.d = node.d
LEFT JOIN node up ON up.d = node.d - 1 AND up.p = node.p[1:node.d - 1]
"""
