"""Assemble the star schema from three Bronze extracts, lazily.

``Star`` wires Silver, the dimensions, the calendar and the fact. With
``stage=False`` every attribute is a lazy DataFrame, so asking for one
report plans only what it needs. With ``stage=True`` each layer is
written once, on first use, to the shared checkpoint folder and read back
from there, as the layers of a warehouse are tables: later jobs do not
recompute the lineage, and a lost executor costs a re-read of staged
files, not a rerun from the raw extracts. Bronze is staged too, so the
extract's joins run once. Silver's valid and rejected rows are staged by
one write (the de-duplication shuffle is shared). ``build`` runs the
independent layers of each wave concurrently.
``from_tables`` builds it from the TPC-H-style driver tables.
"""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators.quarantine import Split
from ..sources import extracts, tables
from . import dimensions, fact, silver

# Fixed value: the audit time stamped on derived rows in reproducible runs.
FIXED_NOW = "2024-01-01 00:00:00"


class Star:
    def __init__(self, bronze_customers: DataFrame, bronze_products: DataFrame,
                 bronze_orders: DataFrame, now=FIXED_NOW, calendar: DataFrame | None = None, stage: bool = False):
        self._bronze = {"customers": bronze_customers, "products": bronze_products,
                        "orders": bronze_orders}
        self.now = now
        self._calendar = calendar
        self.stage = stage
        self.staged_paths: list = []

    def _keep(self, df: DataFrame, label: str) -> DataFrame:
        return tables.stage(df, label, track=self.staged_paths) if self.stage else df

    def release(self, spark: SparkSession) -> None:
        """Drop the staged layers (call when no DataFrame of this Star is needed)."""
        tables.drop_paths(spark, self.staged_paths)

    # Bronze is a layer too: staged, both Silver branches read Parquet and the
    # missing-key branch is answered from row-group statistics.
    @cached_property
    def bronze_customers(self) -> DataFrame:
        return self._keep(self._bronze["customers"], "bronze_customers")

    @cached_property
    def bronze_products(self) -> DataFrame:
        return self._keep(self._bronze["products"], "bronze_products")

    @cached_property
    def bronze_orders(self) -> DataFrame:
        return self._keep(self._bronze["orders"], "bronze_orders")

    # Staged, Silver holds no raw text and no measure that follows from the values beside it; readers make them again.
    def _tagged(self, tag, bronze: DataFrame, label: str, derive=None) -> DataFrame:
        if not self.stage:
            return tag(bronze)
        return silver.unpacked(self._keep(tag(bronze, packed=True), label), derive)

    def _split(self, tag, bronze: DataFrame, columns: list, label: str) -> Split:
        return silver.split_tagged(self._tagged(tag, bronze, label), columns, self.now)

    @cached_property
    def silver_customers_split(self) -> Split:
        return self._split(silver.tag_customers, self.bronze_customers, silver.CUSTOMER_COLUMNS,
                           "silver_customers")

    @cached_property
    def silver_products_split(self) -> Split:
        return self._split(silver.tag_products, self.bronze_products, silver.PRODUCT_COLUMNS,
                           "silver_products")

    @cached_property
    def silver_orders_tagged(self) -> DataFrame:
        """Latest row per order line with its reject reasons (valid and rejected)."""
        return self._tagged(silver.tag_orders, self.bronze_orders, "silver_orders", silver.with_order_measures)

    @cached_property
    def silver_orders_split(self) -> Split:
        return silver.split_tagged(self.silver_orders_tagged, silver.ORDER_COLUMNS, self.now)

    @property
    def silver_customers(self) -> DataFrame:
        return self.silver_customers_split.valid

    @property
    def silver_products(self) -> DataFrame:
        return self.silver_products_split.valid

    @property
    def silver_orders(self) -> DataFrame:
        return self.silver_orders_split.valid

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self._keep(dimensions.dim_customer(self.silver_customers, self.now), "dim_customer")

    @cached_property
    def dim_product(self) -> DataFrame:
        return self._keep(dimensions.dim_product(self.silver_products, self.now), "dim_product")

    @cached_property
    def dim_geography(self) -> DataFrame:
        return self._keep(dimensions.dim_geography(self.silver_customers, self.now), "dim_geography")

    @cached_property
    def dim_date(self) -> DataFrame:
        if self._calendar is not None:
            return self._calendar
        return self._keep(dimensions.dim_date_covering(self.silver_orders, ["order_date", "ship_date"]),
                          "dim_date")

    @cached_property
    def fact_sales(self) -> DataFrame:
        rows = fact.fact_sales(self.silver_orders, self.dim_customer, self.dim_product,
                               self.dim_date, self.dim_geography, self.now)
        return fact.unpacked(self._keep(fact.packed(rows), "fact_sales")) if self.stage else rows

    # Layers in dependency order; the members of one wave are independent.
    WAVES = (("bronze_customers", "bronze_products", "bronze_orders"),
             ("silver_customers_split", "silver_products_split", "silver_orders_split"),
             ("dim_customer", "dim_product", "dim_geography", "dim_date"),
             ("fact_sales",))

    def build(self, max_workers: int = 4) -> "Star":
        """Materialise every layer, running the independent jobs of a wave
        concurrently (Spark schedules jobs from several driver threads), so
        small dimension jobs overlap instead of queueing behind each other."""
        with ThreadPoolExecutor(max_workers=max_workers) as pool:
            for wave in self.WAVES:
                list(pool.map(lambda name: getattr(self, name), wave))
        return self


def from_tables(spark: SparkSession, sf_dir: str, **kw) -> Star:
    return Star(extracts.customer_extract(spark, sf_dir), extracts.product_extract(spark, sf_dir),
                extracts.order_extract(spark, sf_dir), **kw)
