"""A table of the latest row of each key, in key-hash buckets.

Which row of a key is latest is decided by an order that does not depend on when
a row arrives, so the latest of (rows so far, new batch) is the latest of all rows
ever landed: a load needs the table's buckets that its own keys fall in, and no
history. Only buckets in which a row changed are rewritten; a batch that was
loaded before changes nothing.

``<path>/<n>/bucket=<i>/`` holds the rows whose key hashes to bucket ``i`` of ``n``;
``<path>/_buckets`` names the ``n`` in use. ``n`` is a power of two, so a table that
has outgrown it splits every bucket in two or more (``rebucket``), into a folder of
its own: readers follow the file, which is replaced last.

One writer per table at a time. Buckets are replaced one by one; a load that died
between two of them is repeated as a whole, and finds the finished ones unchanged.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from . import tables

BUCKET = "bucket"
#: Bytes a bucket should have, and the bounds of their number.
BUCKET_BYTES = 256 << 20
LEAST_BUCKETS, MOST_BUCKETS = 16, 1 << 16
_T, _S = "__t_", "__s_"


def bucket_of(key: str, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias(BUCKET)


@dataclass
class Merge:
    """A planned merge: ``after`` is the table as it will be, ``changes`` its inserted and replaced rows.

    ``changes`` has the table's columns and ``__before``, the row that was replaced (NULL for an insert, and
    where the merge was asked not to keep it).
    """

    table: "BucketTable"
    merged: DataFrame
    changes: DataFrame
    after: DataFrame
    touched: list

    def commit(self) -> int:
        """Rewrite the touched buckets; their number."""
        if self.touched:
            rows = self.merged.filter(F.col(BUCKET).isin(self.touched)).select(*self.table.schema.names, BUCKET)
            tables.write(rows, self.table.folder, "overwrite", [BUCKET], cluster_by=[self.table.key], dynamic=True)
        return len(self.touched)


class BucketTable:
    def __init__(self, spark: SparkSession, path: str, key: str, schema: StructType, least_buckets: int = LEAST_BUCKETS):
        self.spark, self.path, self.key, self.least = spark, path.rstrip("/"), key, least_buckets
        self.schema = StructType([StructField(f.name, f.dataType, True) for f in schema])

    @property
    def buckets(self) -> int | None:
        text = tables.get_text(self.spark, f"{self.path}/_buckets")
        return int(text) if text else None

    @property
    def folder(self) -> str:
        return f"{self.path}/{self.buckets}"

    def _folders(self) -> list:
        """The folders of buckets that hold rows."""
        fs, p = tables._fs(self.spark, self.folder)
        there = {s.getPath().getName() for s in fs.listStatus(p)} if fs.exists(p) else set()
        return sorted(x for x in there if x.startswith(f"{BUCKET}="))

    def _no_row(self) -> Column:
        return F.lit(None).cast(StructType(self.schema.fields))

    def read(self, buckets=None) -> DataFrame:
        """All rows, or those of some buckets: then nothing else is listed or read."""
        n = self.buckets
        whole = StructType([*self.schema, StructField(BUCKET, IntegerType(), True)])
        if n is None:
            return self.spark.createDataFrame([], whole)
        names = self._folders()
        if buckets is not None:
            wanted = {f"{BUCKET}={b}" for b in buckets}
            names = [x for x in names if x in wanted]
        if not names:
            return self.spark.createDataFrame([], whole)
        reader = self.spark.read.schema(whole).option("basePath", f"{self.path}/{n}")
        return reader.parquet(*([f"{self.path}/{n}"] if buckets is None else [f"{self.path}/{n}/{x}" for x in names]))

    def buckets_of(self, keys: DataFrame) -> list:
        """The buckets that the keys of ``keys`` fall in: at most ``MOST_BUCKETS`` numbers."""
        return sorted(r[0] for r in keys.select(bucket_of(self.key, self.buckets)).distinct().collect())

    def rows_of(self, keys: DataFrame) -> DataFrame:
        """The rows of some keys, from their buckets only."""
        if self.buckets is None:
            return self.read().drop(BUCKET)
        return self.read(self.buckets_of(keys)).join(keys.select(self.key).distinct(), self.key, "left_semi").drop(BUCKET)

    def _size(self, staged: DataFrame) -> int:
        """Bytes of the staged files of ``staged``."""
        fs, p = tables._fs(self.spark, staged)
        return fs.getContentSummary(p).getLength()

    def merge(self, new: DataFrame, order_col: str, tiebreak: list, stamps=("created_at", "updated_at"), staged: list | None = None,
              new_bytes: int | None = None, keep_before: bool = True) -> Merge:
        """Plan the merge of ``new``, one row a key, and no NULL key.

        The row with the greater ``order_col`` stays (NULL is least), then the one with the
        smaller ``tiebreak`` columns (NULL first), then the one that is there. A replaced row
        keeps the first of the ``stamps``. Both sides have one row a key, so the join has no
        hot key; it reads the buckets of the new keys only. ``new_bytes`` says that ``new``
        is staged already, with so many bytes; without ``keep_before`` replaced rows are not kept.
        The rows of a first load are the table: they are not joined, nor staged again.
        """
        staged = [] if staged is None else staged
        if new_bytes is None:
            new = tables.stage(new, "new_rows", track=staged)
            new_bytes = self._size(staged[-1])
        if self.buckets is None:
            n = self.least
            while n < MOST_BUCKETS and n * BUCKET_BYTES < new_bytes:
                n *= 2
            tables.put_text(self.spark, f"{self.path}/_buckets", str(n))
        elif 4 * self.buckets * BUCKET_BYTES < tables._fs(self.spark, self.folder)[0].getContentSummary(tables._fs(self.spark, self.folder)[1]).getLength():
            self.rebucket(min(MOST_BUCKETS, 4 * self.buckets))
        near = self.buckets_of(new)
        names = self.schema.names
        if not self._folders():
            merged = new.select(*names).withColumn(BUCKET, bucket_of(self.key, self.buckets))
            return Merge(self, merged, new.select(*names, self._no_row().alias("__before")), new.select(*names), near)
        old = self.read(near)
        t = old.select(*[F.col(c).alias(_T + c) for c in names], F.lit(True).alias("__t"))
        s = new.select(*[F.col(c).alias(_S + c) for c in names], F.lit(True).alias("__s"))
        j = t.join(s, t[_T + self.key] == s[_S + self.key], "full")
        side = lambda x, cols: F.struct(*[F.col(x + c) for c in cols])
        later = side(_S, [order_col]) > side(_T, [order_col])
        same = F.col(_S + order_col).eqNullSafe(F.col(_T + order_col))
        wins = F.col("__s").isNotNull() & (F.col("__t").isNull() | later | (same & (side(_S, tiebreak) < side(_T, tiebreak))))
        pick = {c: F.when(wins, F.col(_S + c)).otherwise(F.col(_T + c)) for c in names}
        if stamps[0] in names:
            pick[stamps[0]] = F.coalesce(_T + stamps[0], _S + stamps[0])
        before = F.when(F.col("__t").isNotNull(), F.struct(*[F.col(_T + c).alias(c) for c in names]))
        kept = F.when(wins, before) if keep_before else self._no_row()
        merged = j.select(*[e.alias(c) for c, e in pick.items()], wins.alias("__changed"), kept.alias("__before"))
        merged = tables.stage(merged.withColumn(BUCKET, bucket_of(self.key, self.buckets)), "merged_rows", track=staged)
        changes = merged.filter("__changed")
        touched = sorted(r[0] for r in changes.select(BUCKET).distinct().collect())
        far = self.read([b for b in range(self.buckets) if b not in set(near)])
        after = merged.select(*names).unionByName(far.select(*names))
        return Merge(self, merged, changes.select(*names, "__before"), after, touched)

    def rebucket(self, n: int) -> None:
        """Spread the rows over ``n`` buckets; the old folder goes once readers are led to the new one."""
        old = self.buckets
        rows = self.read().drop(BUCKET).withColumn(BUCKET, bucket_of(self.key, n))
        tables.write(rows, f"{self.path}/{n}", "overwrite", [BUCKET], cluster_by=[self.key])
        tables.put_text(self.spark, f"{self.path}/_buckets", str(n))
        fs, p = tables._fs(self.spark, f"{self.path}/{old}")
        if old != n:
            fs.delete(p, True)
