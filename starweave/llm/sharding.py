"""Sharding (5): weighted rendezvous hashing of stable record keys.

A record goes to the shard with the greatest ``-weight / ln(u)``, where ``u`` is
drawn from (0, 1) by the MD5 of key and shard number. Which shard that is depends
on nothing but the key and the shards, so a further shard can only take records,
and a raised weight can only draw records, into itself.

Slots number a shard's rows without gaps, by the hash of the key. A shard may
hold any part of the data, so its rows are numbered in ranges of that hash; rows
that share a key are counted per input partition first, so one frequent key is
no large group either. Texts are read once and never shuffled.

Only DataFrame functions run here. Defined results: a NULL text has no bytes
(size 8, CRC 0); a NULL key is a key like others; rows of one key share a shard
and have slots of their own; extra columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ._cluster import checkpointed

SHARDS = 24
#: Bytes that a record has besides its text.
RECORD_BYTES = 8
#: Rows of a shard that are numbered in one window, about.
RANGE_ROWS = 4096
_BITS = 52


def _hex_bits(text: Column, digits: int) -> Column:
    """The first hexadecimal digits of the MD5 as a whole number."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def _draw(key: Column, shard: Column, weight: Column) -> Column:
    u = (_hex_bits(F.concat(key, F.lit(":"), shard.cast("string")), _BITS // 4) + F.lit(0.5)) / F.lit(float(1 << _BITS))
    # Of equal draws the smaller shard wins.
    return F.struct((-weight / F.ln(u)).alias("draw"), (-shard).alias("minus"))


def shard_of(key: Column, weights: Sequence[float]) -> tuple[Column, Column]:
    """The shard of a key among shards of these weights, and with one more of weight 1."""
    all_weights = F.array(*[F.lit(float(w)) for w in weights])
    best = F.array_max(F.transform(all_weights, lambda w, i: _draw(key, i, w)))
    grown = F.greatest(best, _draw(key, F.lit(len(weights)), F.lit(1.0)))
    return (-best["minus"]).cast("int"), (-grown["minus"]).cast("int")


def shard(docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot, grown_shard`` of each row of ``docs(doc_id, text)``."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    now, grown = shard_of(F.col("k"), weights)
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("k"),
                        (F.coalesce(F.octet_length("text"), F.lit(0)) + RECORD_BYTES).cast("long").alias("size"),
                        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"))
            .withColumn("shard", now).withColumn("grown_shard", grown).withColumn("h", _hex_bits(F.col("k"), 15))
            .withColumn("part", F.spark_partition_id()).withColumn("n", F.monotonically_increasing_id()))
    rows = checkpointed(rows)
    ranges = max(1, rows.count() // (len(weights) * RANGE_ROWS))
    rows = rows.withColumn("range", F.shiftright("h", 60 - (ranges - 1).bit_length()))
    group = ["shard", "range", "h", "k", "part"]
    groups = rows.groupBy(*group).agg(F.count("*").alias("c"))
    order = Window.partitionBy("shard", "range").orderBy("h", "k", "part").rowsBetween(Window.unboundedPreceding, -1)
    begins = groups.withColumn("begin", F.coalesce(F.sum("c").over(order), F.lit(0)))
    sizes = rows.groupBy("shard", "range").agg(F.count("*").alias("c"))
    upto = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("shard", "range", F.coalesce(F.sum("c").over(upto), F.lit(0)).alias("base"))
    place = F.row_number().over(Window.partitionBy(*group).orderBy("text_crc32", "n")) - 1
    return (rows.withColumn("place", place).join(begins.drop("c"), group).join(bases, ["shard", "range"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("begin") + F.col("place")).cast("long").alias("slot"), "grown_shard"))


def op5_sharding(spark, sf_dir: str) -> DataFrame:
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


_HEX = "'0123456789abcdef'"


def _sql_bits(text: str, digits: int) -> str:
    return f"list_reduce(list_prepend(0, list_transform(range({digits}), lambda i: instr({_HEX}, substr(md5({text}), CAST(i AS INT) + 1, 1)) - 1)), lambda a, b: a * 16 + b)"


ORACLE_SQL = f"""
WITH poly AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
              FROM (SELECT unnest(range(256)) AS i)),
doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS k, coalesce(text, '') AS text FROM documents),
bytes AS (SELECT r, lower(hex(encode(text))) AS x, octet_length(encode(text)) AS n FROM doc),
crc AS (SELECT r, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(n), lambda i: 16 * (instr({_HEX}, substr(x, 2 * i + 1, 1)) - 1)
                                                                         + instr({_HEX}, substr(x, 2 * i + 2, 1)) - 1)),
                                     lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc
        FROM bytes, poly),
draw AS (SELECT r, s, {_sql_bits("k || ':' || s", _BITS // 4)} AS d FROM doc, (SELECT unnest(range({SHARDS + 1})) AS s)),
best AS (SELECT r, first(s ORDER BY d DESC, s) FILTER (WHERE s < {SHARDS}) AS shard, first(s ORDER BY d DESC, s) AS grown FROM draw GROUP BY r)
SELECT doc_id, CAST(n + {RECORD_BYTES} AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INT) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY {_sql_bits("k", 15)}, k, crc) - 1 AS slot, CAST(grown AS INT) AS grown_shard
FROM doc JOIN crc USING (r) JOIN best USING (r)
"""
