"""Silver kept up to date load by load, without a read of what was landed before.

A Silver table holds the latest row of each key, valid or not, with the rules that
it breaks (``reject_reasons``), in key-hash buckets (``sources.buckets``). Which row is
latest does not depend on the order of arrival, so a batch of Bronze is tagged by
itself and merged: a late row that is older than the kept one changes nothing, and a
key whose latest row has become invalid leaves the valid rows. Only the buckets of the
batch's keys are read, and only those with a changed row are written.

Rows without a key belong to no bucket: they are appended to ``unkeyed``, with the id
of their batch as partition, so a batch that is loaded again replaces its own.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.quarantine import Split
from ..sources import tables
from ..sources.buckets import BucketTable
from . import silver


@dataclass(frozen=True)
class Kind:
    """What makes one Silver table: how rows are tagged, their key, tie-break and columns."""

    tag: Callable[[DataFrame], DataFrame]
    key: str
    tiebreak: tuple
    columns: tuple


CUSTOMERS = Kind(silver.tag_customers, "customer_id", tuple(silver.CUSTOMER_TIEBREAK), tuple(silver.CUSTOMER_COLUMNS))
PRODUCTS = Kind(silver.tag_products, "product_id", tuple(silver.PRODUCT_TIEBREAK), tuple(silver.PRODUCT_COLUMNS))
ORDERS = Kind(silver.tag_orders, "order_line_id", tuple(silver.ORDER_TIEBREAK), tuple(silver.ORDER_COLUMNS))


class SilverTable:
    def __init__(self, spark: SparkSession, path: str, kind: Kind, bronze_schema: StructType, least_buckets: int | None = None):
        self.spark, self.kind, self.unkeyed = spark, kind, f"{path}/unkeyed"
        self.schema = kind.tag(spark.createDataFrame([], bronze_schema)).schema
        more = {} if least_buckets is None else {"least_buckets": least_buckets}
        self.latest = BucketTable(spark, f"{path}/latest", kind.key, self.schema, **more)

    def load(self, batch: DataFrame, batch_id: str) -> int:
        """Merge the rows of one Bronze batch; the number of buckets that were written."""
        staged: list = []
        try:
            tagged = tables.stage(self.kind.tag(batch).select(*self.schema.names), "silver_batch", track=staged)
            size = self.latest._size(staged[-1])
            merge = self.latest.merge(tagged.filter(F.col(self.kind.key).isNotNull()), "ingested_at",
                                      [*self.kind.tiebreak, *[c for c in self.schema.names if c.startswith("_raw_")]], staged=staged,
                                      new_bytes=size, keep_before=False)
            written = merge.commit()
            without = tagged.filter(F.col(self.kind.key).isNull()).withColumn("load_id", F.lit(batch_id))
            tables.write(without, self.unkeyed, "overwrite", ["load_id"], dynamic=True)
            return written
        finally:
            tables.drop_paths(self.spark, staged)

    def tagged(self) -> DataFrame:
        """The latest row of each key, and all rows without one."""
        rows = self.latest.read().select(*self.schema.names)
        if not tables.exists(self.spark, self.unkeyed):
            return rows
        return rows.unionByName(self.spark.read.schema(self.schema).parquet(self.unkeyed).select(*self.schema.names))

    def split(self, now=None) -> Split:
        """Valid and rejected rows, as a rebuild from all of Bronze would give them."""
        return silver.split_tagged(self.tagged(), list(self.kind.columns), now)
