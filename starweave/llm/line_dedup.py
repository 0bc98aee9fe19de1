"""Line dedup (9): repeated line runs found by distributed prefix doubling.

The suffixes are those of every document's sequence of line ids. Round ``k``
names the run of ``2**k`` lines at each place by the names of its two halves;
places with equal names are one interval of the suffix array, whose common
prefix has ``2**k`` lines or more. Only intervals of several suffixes go on, so
the rounds shrink, and they end when no longer run repeats. The places of an
interval but the first, by ``doc_id``, then by the text's hash, then by line,
are later copies. A line is deleted if it lies in a later copy of a run that
has ``MIN_CHARS`` characters or more, whatever its number of lines: each line of
such a run lies in one of ``2**k`` lines, in the shortest long enough one from a
line on, or in the shortest long enough one up to a line. The names of two
overlapping runs of ``2**k`` lines are the name of any run of fewer than twice as
many. Names are 128-bit hashes instead of sorted ranks, so a round needs no
global sort.

Only DataFrame functions run here. Line ids, places and lengths are shuffled;
the texts are not, unless the deletions are too large to broadcast.

Defined results: a NULL text stays NULL and has no lines; an empty text is one
empty line; a NULL ``doc_id`` comes first; rows that repeat both id and text
are one document, and each of them is edited alike; ties have the text's hash
as their order; other columns pass through, whatever their names; an empty
table gives an empty one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ._cluster import checkpointed, small_side

#: A repeated run of fewer characters is left alone ("Yes.", blank lines).
MIN_CHARS = 25

_NO_ID = -(1 << 63)


def _keys() -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("d"), F.xxhash64("text").alias("t")]


def _shortest(active: DataFrame, min_chars: int) -> DataFrame:
    """``d, t, line, lines``: for each line, the shortest runs of ``min_chars`` characters that begin and that end there.

    Lines that are left out make a run too long in lines; it then has no name.
    """
    so_far = F.sum("n").over(Window.partitionBy("d", "t").orderBy("line"))
    total = active.select("d", "t", "line", so_far.alias("upto"), (so_far - F.col("n")).alias("before"))
    row = lambda at, place, of: total.select("d", "t", F.col(at).alias("at") if isinstance(at, str) else at.alias("at"), place.alias("place"), of.alias("of"))
    none, line = F.lit(None).cast("int"), F.col("line")
    order = Window.partitionBy("d", "t").rowsBetween(Window.unboundedPreceding, 0)
    ends = row("upto", line, none).union(row(F.col("before") + min_chars, none, line)).withColumn(
        "place", F.min("place").over(order.orderBy(F.desc("at"), F.col("of").asc_nulls_first())))
    begins = row("before", line, none).union(row(F.col("upto") - min_chars, none, line)).withColumn(
        "place", F.max("place").over(order.orderBy(F.asc("at"), F.col("of").asc_nulls_first())))
    runs = ends.filter("of IS NOT NULL AND place IS NOT NULL").select("d", "t", F.col("of").alias("line"), (F.col("place") - F.col("of") + 1).alias("lines"))
    return runs.union(begins.filter("of IS NOT NULL AND place IS NOT NULL").select("d", "t", F.col("place").alias("line"), (F.col("of") - F.col("place") + 1).alias("lines"))).distinct()


def _between(active: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """Later copies of the ``wanted`` runs of more than ``size`` and fewer than twice as many lines, named by two of ``size``."""
    place = F.struct("d", "t", "line")
    second = active.select("d", "t", F.col("line").alias("line2"), F.col("a").alias("a2"), F.col("b").alias("b2"))
    named = checkpointed(wanted.filter(F.col("lines").between(size + 1, 2 * size - 1)).join(active.select("d", "t", "line", "a", "b"), ["d", "t", "line"])
                         .withColumn("line2", F.col("line") + F.col("lines") - size).join(second, ["d", "t", "line2"]))
    # Whether a run is a shortest one depends on its own lines only, so all its places are wanted.
    name = ["lines", "a", "b", "a2", "b2"]
    first = named.groupBy(*name).agg(F.min(place).alias("first"), F.count("*").alias("c")).filter("c > 1").select(*name, "first")
    return (named.join(first, name).filter(place != F.col("first"))
            .select("d", "t", "line", "lines", F.col("first.d").alias("first_d"), F.col("first.line").alias("first_line")))


def repeated_runs(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Later copies: ``d, t`` (the document), ``line``, ``lines``, ``first_d``, ``first_line``.

    One row for each place and round, and for each shortest run, with the first place of the same run.
    """
    line = (docs.filter(F.col("text").isNotNull()).select(*_keys(), F.posexplode(F.split("text", "\n", -1)).alias("line", "s"))
            .select("d", "t", "line", F.xxhash64("s").alias("a"), F.xxhash64(F.lit(1), "s").alias("b"), F.length("s").alias("n")))
    line = checkpointed(line)
    often = line.groupBy("a", "b").agg(F.count("*").alias("c")).filter("c > 1").select("a", "b")
    active = line.join(often, ["a", "b"]).groupBy("d", "t", "line").agg(*[F.first(c).alias(c) for c in ("a", "b", "n")])
    place, size, found, wanted, most = F.struct("d", "t", "line"), 1, [], None, 0
    while True:
        active = checkpointed(active)
        first = (active.groupBy("a", "b").agg(F.count("*").alias("c"), F.min(place).alias("first"))
                 .filter("c > 1").select("a", "b", "first"))
        active = checkpointed(active.join(first, ["a", "b"]))
        found.append(active.filter((place != F.col("first")) & (F.col("n") >= min_chars))
                     .select("d", "t", "line", F.lit(size).alias("lines"), F.col("first.d").alias("first_d"),
                             F.col("first.line").alias("first_line")))
        if active.isEmpty():
            break
        if wanted is None:
            wanted = checkpointed(_shortest(active, min_chars).filter(F.col("lines") > 2))
            most = wanted.agg(F.max("lines")).first()[0] or 0
        elif size < most:
            found.append(_between(active, wanted, size))
        beyond = Window.partitionBy("d", "t").orderBy("line").rangeBetween(size, size)
        joined = active.select("d", "t", "line", "a", "b", "n", *[F.first(c).over(beyond).alias(f"{c}2") for c in ("a", "b", "n")])
        active = (joined.filter("a2 IS NOT NULL")
                  .select("d", "t", "line", F.xxhash64("a", "a2").alias("a"), F.xxhash64("b", "b2").alias("b"),
                          (F.col("n") + F.col("n2")).alias("n")))
        size *= 2
    return reduce(DataFrame.union, found)


def deletions(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``d, t, cut``: for each document that loses lines, the sorted stretches ``[from, to)`` of lines to delete."""
    runs = (repeated_runs(docs, min_chars).groupBy("d", "t", "line").agg(F.max("lines").alias("lines"))
            .withColumn("to", F.col("line") + F.col("lines")))
    order = Window.partitionBy("d", "t").orderBy("line")
    reach = F.max("to").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = runs.withColumn("new", F.coalesce((F.col("line") > reach).cast("int"), F.lit(1)))
    stretch = marked.withColumn("no", F.sum("new").over(order)).groupBy("d", "t", "no").agg(F.min("line").alias("from"), F.max("to").alias("to"))
    return stretch.groupBy("d", "t").agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias("cut"))


def _edited(docs: DataFrame, min_chars: int) -> DataFrame:
    """The documents as ``row`` (all columns), with ``kept`` (text), ``had`` and ``lost`` (numbers of lines)."""
    cut = checkpointed(deletions(docs.select("doc_id", "text"), min_chars))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text")
    whole = whole.select("row", "text", *_keys())
    both = whole.join(small_side(cut, 256), ["d", "t"], "left").withColumn("part", F.split("text", "\n", -1))

    def upto(stretch: Column, i: Column) -> Column:
        begin = F.when(i == 0, F.lit(0)).otherwise(F.get("cut", i - 1)["to"])
        return F.slice("part", begin + 1, stretch["from"] - begin)

    end = F.element_at("cut", -1)["to"]
    rest = F.slice("part", end + 1, F.size("part") - end)
    text = F.array_join(F.concat(F.flatten(F.transform("cut", upto)), rest), "\n")
    lost = F.aggregate("cut", F.lit(0), lambda n, x: n + x["to"] - x["from"])
    gone = F.col("cut").isNotNull() & F.col("text").isNotNull()
    return both.select("row", F.when(gone, text).otherwise(F.col("text")).alias("kept"),
                       F.when(F.col("text").isNull(), 0).otherwise(F.size("part")).alias("had"),
                       F.when(gone, lost).otherwise(0).alias("lost"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents without later copies of repeated runs; same columns.

    ``n_chars``, if there, follows the text. A document that deletion leaves
    with nothing but white space is dropped; one that had no more stays.
    """
    out = _edited(docs, min_chars).filter((F.col("lost") == 0) | (F.trim(F.regexp_replace("kept", r"\s+", "")) != ""))
    new = {"text": F.col("kept"), "n_chars": F.when(F.col("lost") > 0, F.length("kept")).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return out.select(*[(new[c] if new.get(c) is not None else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return _edited(docs, MIN_CHARS).select(
        F.col("row.doc_id").alias("doc_id"), F.col("had").cast("long").alias("n_lines"), F.col("lost").cast("long").alias("n_deleted"),
        F.sha2("kept", 256).alias("kept_sha256"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: later copies of repeated line runs are cut out of the texts."""
    return dedup_lines(docs)


#: Later copies of runs of MIN_CHARS characters or more, of any number of lines, cover their lines. A line of such a
#: copy also lies in the shortest long enough run from some line on or up to some line, and that one is a later copy too.
ORACLE_SQL = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, text, string_split(text, chr(10)) AS part FROM documents),
line AS (SELECT r, doc_id, unnest(range(len(part))) AS p, unnest(part) AS s FROM doc WHERE text IS NOT NULL),
named AS (SELECT r, doc_id, p, dense_rank() OVER (ORDER BY s) AS id, length(s) AS n FROM line),
total AS (SELECT r, doc_id, p, sum(n) OVER (PARTITION BY r ORDER BY p) AS upto, sum(n) OVER (PARTITION BY r ORDER BY p) - n AS before FROM named),
seq AS (SELECT r, list(id ORDER BY p) AS ids FROM named GROUP BY r),
ends AS (SELECT r, upto, min(p) AS p FROM total GROUP BY r, upto),
begins AS (SELECT r, before, max(p) AS p FROM total GROUP BY r, before),
runs AS (SELECT a.r, a.doc_id, a.p, e.p - a.p + 1 AS w FROM total a ASOF JOIN ends e ON a.r = e.r AND a.before + {MIN_CHARS} <= e.upto
         UNION SELECT a.r, a.doc_id, b.p, a.p - b.p + 1 FROM total a ASOF JOIN begins b ON a.r = b.r AND a.upto - {MIN_CHARS} >= b.before),
win AS (SELECT runs.r, doc_id, p, w, ids[p + 1 : p + w] AS k FROM runs JOIN seq ON runs.r = seq.r),
seen AS (SELECT *, row_number() OVER (PARTITION BY w, k ORDER BY doc_id NULLS FIRST, p) AS nth FROM win),
gone AS (SELECT DISTINCT r, unnest(range(p, p + w)) AS p FROM seen WHERE nth > 1),
kept AS (SELECT l.r, string_agg(l.s, chr(10) ORDER BY l.p) AS s FROM line l ANTI JOIN gone g ON l.r = g.r AND l.p = g.p GROUP BY l.r),
lost AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT d.doc_id, CAST(coalesce(len(d.part), 0) AS BIGINT) AS n_lines, coalesce(g.n, 0) AS n_deleted,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(k.s, '')) END AS kept_sha256
FROM doc d LEFT JOIN lost g ON d.r = g.r LEFT JOIN kept k ON d.r = k.r
"""
