"""Clustered rewrite: compaction plus Z-order on chosen columns.

Open-source Spark has no ``OPTIMIZE ... ZORDER BY``, so the layout is
produced by a plain Spark job:

1. a bounded sample of rows (the smallest row hashes; one job) is sorted in
   the driver to give at most 2^bits - 1 split points per column, in the
   column's own order: numbers, dates and whole strings alike;
2. a binary search over the split points (JVM built-ins) turns each value into
   its rank bucket, so skewed columns still spread evenly;
3. the bucket bits are interleaved into one z-value with shift / and / or
   built-ins;
4. ``repartitionByRange(z)`` + ``sortWithinPartitions(z)`` give files whose
   min/max statistics on every clustering column are tight, which is what
   Parquet row-group skipping needs. The number of files follows the data
   (adaptive execution sizes the partitions) unless one is asked for.

Rows are neither added nor dropped: the output is the same multiset. The input
is read for the sample, for the ranges and for the write: stage it if it is
dear to compute. NULLs, and columns without values, fall into bucket 0.
"""
from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

# 10 bits per column (1024 rank buckets), and the rows of the sample.
DEFAULT_BITS = 10
SAMPLE_ROWS = 16_384


def _sort_key(df: DataFrame, c: str) -> Column:
    t = df.schema[c].dataType
    if isinstance(t, (NumericType, BooleanType)):
        return F.col(c).cast("double")
    if isinstance(t, (DateType, TimestampType, TimestampNTZType)):
        return F.unix_micros(F.col(c).cast("timestamp")).cast("double")
    if isinstance(t, StringType):
        return F.hex(F.col(c).cast("binary"))  # bytes in hexadecimal: the same order, in any collation
    return F.xxhash64(F.col(c)).cast("double")


def _rank(key: Column, splits: list) -> Column:
    """How many split points are at or below the key, by binary search; 0 for NULL."""
    if not splits:
        return F.lit(0)
    kind = "string" if isinstance(splits[0], str) else "double"
    held = F.from_json(F.lit(json.dumps(splits)), f"array<{kind}>")  # folded to one constant
    steps = F.array(*[F.lit(1 << k) for k in range(len(splits).bit_length() - 1, -1, -1)])
    found = F.aggregate(steps, F.lit(0), lambda low, step: F.when(
        (low + step <= len(splits)) & (F.get(held, low + step - 1) <= key), low + step).otherwise(low))
    return F.when(key.isNull(), F.lit(0)).otherwise(found)


def _splits(values: list, buckets: int) -> list:
    values = sorted(v for v in values if v is not None and v == v)
    return sorted({values[len(values) * i // buckets] for i in range(1, buckets)}) if values else []


def zorder(df: DataFrame, columns, bits: int = DEFAULT_BITS, num_partitions: int | None = None) -> DataFrame:
    columns = list(columns)
    bits = max(1, min(bits, 62 // len(columns)))  # all columns' bits share one LONG
    keys = [f"__zk{i}" for i in range(len(columns))]
    keyed = df.withColumns({k: _sort_key(df, c) for k, c in zip(keys, columns)})
    everything = [F.col(c) for c in df.columns]
    sample = (keyed.select(*keys, F.xxhash64(F.monotonically_increasing_id(), *everything).alias("__draw"))
              .orderBy("__draw").limit(SAMPLE_ROWS).collect())
    ranked = keyed.withColumns({f"__zb{i}": _rank(F.col(k), _splits([r[k] for r in sample], 2 ** bits)).cast("long")
                                for i, k in enumerate(keys)})
    z = F.lit(0).cast("long")
    for j in range(bits):
        for i in range(len(columns)):
            bit = F.shiftright(F.col(f"__zb{i}"), j).bitwiseAND(F.lit(1))
            z = z.bitwiseOR(F.shiftleft(bit, j * len(columns) + i))
    # Inside a run of equal z-values the keys themselves, then a row hash, decide, so a run
    # (e.g. many copies of one row) can be split across files.
    zed = ranked.withColumn("__z", z).withColumn("__h", F.xxhash64(*everything))
    order = ["__z", *keys, "__h"]
    spread = zed.repartitionByRange(num_partitions, *order) if num_partitions else zed.repartitionByRange(*order)
    return spread.sortWithinPartitions(*order).select(*df.columns)
