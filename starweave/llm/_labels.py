"""Bounded samples of labelled documents; the only thing that labels are used for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ._cluster import checkpointed, small_side


def remainder(doc_id: Column, n: int) -> Column:
    """``crc32(doc_id as text) mod n``; a NULL id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(n))


def labelled(docs: DataFrame, labels: DataFrame, name: str, fold: int, of: int, bound: int) -> DataFrame:
    """``(text, label, share)`` of distinct texts outside the held-out fold, about ``bound`` of each class at most.

    ``share`` is the part of the label's class that was drawn.

    An id with several labels has the largest; a class of more documents than
    ``bound`` is thinned by a hash of the id, which any number of executors
    computes alike. Rows without an id, a label or a text don't count.
    """
    own = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(name).cast("int").alias("label"))
           .filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), of) != fold))
           .groupBy("doc_id").agg(F.max("label").alias("label")))
    own = checkpointed(own)
    size = {r["label"]: r["count"] for r in own.groupBy("label").count().collect()}
    if not size:
        return docs.select("text", F.lit(0).alias("label"), F.lit(1.0).alias("share")).limit(0)
    share = F.coalesce(*[F.when(F.col("label") == k, F.lit(min(1.0, bound / n))) for k, n in sorted(size.items())])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = checkpointed(own.withColumn("share", share).filter(draw < F.col("share")))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.col("text").isNotNull())
    return checkpointed(found.join(small_side(chosen, 32), "doc_id").groupBy(F.md5("text").alias("m"))
                        .agg(F.first("text").alias("text"), F.max(F.struct("label", "share")).alias("most"))
                        .select("text", "most.label", "most.share"))
