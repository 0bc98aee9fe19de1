"""Raw operational extracts derived from the TPC-H-style tables.

The warehouse expects three string-typed extracts (CRM customers, ERP
products, e-commerce order lines). These functions render them from the
typed ``customer / nation / region / part / orders / lineitem`` tables with
cosmetic dirt (padding, casing, punctuation) that Silver has to clean and, by
modulo rules, bad rows (blank keys, bad dates and numbers, unknown products)
that it has to reject, so the whole Bronze → Gold path does real work at any scale factor.

Each extract is a narrow projection plus equi-joins: ``nation`` and
``region`` are bounded lookups (25 and 5 rows in TPC-H at any scale);
``orders`` is joined to ``lineitem`` on the order key, the one shuffle of
the order extract (Spark picks sort-merge or broadcast by size).
"""
from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .contracts import CRM_CUSTOMERS, ECOM_ORDERS, ERP_PRODUCTS
from .ingest import add_audit_columns

# Fixed values of the derived extracts (our own choices, mirrored by the
# SQL oracle): batch id, landing time of the master-data extracts, and the
# base dates for the synthetic registration and creation dates.
BATCH_ID = "20240101000000"
MASTER_INGESTED_AT = "2024-01-01 00:00:00"
REGISTRATION_BASE = "1992-01-01"
CREATED_BASE = "1990-01-01"
CENT = Decimal("0.01")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spoil(df: DataFrame, key: str, rules: dict) -> DataFrame:
    """Replace values in rows whose key a modulus divides: ``{column: [(modulus, bad value), ...]}``, the first that
    divides wins. ``key`` is dropped."""
    def bad(c, cases):
        out = None
        for modulus, value in cases:
            hit, value = F.col(key) % modulus == 0, value if isinstance(value, Column) else F.lit(value)
            out = F.when(hit, value) if out is None else out.when(hit, value)
        return out.otherwise(F.col(c))
    return df.withColumns({c: bad(c, cases) for c, cases in rules.items()}).drop(key)


# Fixed values of the bad rows (our own choices, mirrored by the SQL oracle): what every rule of Silver must catch.
BAD_CUSTOMERS = {
    "customer_id": [(79, "  ")], "email": [(97, None), (83, "no-at-sign")], "state": [(73, None)],
    "registration_date": [(89, "not a date")]}
BAD_PRODUCTS = {
    "product_id": [(101, " ")], "product_name": [(71, None)], "unit_cost": [(67, "abc"), (59, "99999.00"), (37, "0")],
    "unit_price": [(61, "0.00"), (41, "123456789.999")], "is_active": [(53, "maybe")], "created_date": [(47, "2024-02-30")],
    "weight_kg": [(43, "heavy")]}
BAD_ORDERS = {
    "order_id": [(197, None)], "customer_id": [(191, None)], "product_id": [(139, None), (151, "p999999999")],
    "ship_date": [(179, "2024-02-30")], "quantity": [(173, "abc"), (167, "0"), (113, "1.7"), (109, "2000000000")],
    "unit_price": [(163, "0.00"), (137, "123456789.999"), (109, "99999999.00")], "discount_pct": [(157, "x")]}


def _s(c: Column) -> Column:
    return c.cast("string")


def _cents_to_text(cents: Column, precision: int = 12) -> Column:
    return (cents * F.lit(CENT)).cast(f"decimal({precision},2)").cast("string")


def customer_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (c.join(n, c.c_nationkey == n.n_nationkey, "left")
          .join(r, F.col("n_regionkey") == r.r_regionkey, "left"))
    reg = F.date_add(F.lit(REGISTRATION_BASE).cast("date"), (F.col("c_custkey") % 1000).cast("int"))
    raw = j.select(
        F.concat(F.lit(" c"), _s(F.col("c_custkey"))).alias("customer_id"),
        F.lower(F.split_part(F.col("c_name"), F.lit("#"), F.lit(1))).alias("first_name"),
        F.concat(F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)), F.lit(" ")).alias("last_name"),
        F.concat(F.lit(" "), F.replace(F.col("c_name"), F.lit("#"), F.lit(".")), F.lit("@Example.COM")).alias("email"),
        F.concat(F.lit("+1 ("), _s(F.col("c_nationkey") + 100), F.lit(") 555-"), _s(F.col("c_custkey"))).alias("phone"),
        F.lower(F.col("n_name")).alias("city"),
        F.concat(F.lit(" "), F.lower(F.col("r_name"))).alias("state"),
        F.lit("usa ").alias("country"),
        _s(F.col("c_nationkey") * 10 + F.col("c_custkey") % 3 + 10000).alias("zip_code"),
        F.lower(F.col("c_mktsegment")).alias("customer_segment"),
        F.date_format(reg, "yyyy-MM-dd").alias("registration_date"),
        F.col("c_custkey").alias("_k"),
    )
    raw = _spoil(raw, "_k", BAD_CUSTOMERS)
    assert tuple(raw.columns) == CRM_CUSTOMERS.columns
    return add_audit_columns(raw, CRM_CUSTOMERS.source_system, BATCH_ID, MASTER_INGESTED_AT)


def int_div(a: Column, b: Column) -> Column:
    """Exact floor division of non-negative LONGs (stays integral, no double rounding)."""
    return ((a - F.pmod(a, b)) / b).cast("bigint")


def price_cents(price: Column) -> Column:
    return F.round(price * 100).cast("bigint")


def cost_cents(price_in_cents: Column) -> Column:
    """Synthetic unit cost: 60 % of the list price, rounded half-up to a cent."""
    return int_div(price_in_cents * 6 + 5, F.lit(10))


def product_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    cents = price_cents(F.col("p_retailprice"))
    created = F.date_add(F.lit(CREATED_BASE).cast("date"), (F.col("p_size") * 7).cast("int"))
    raw = p.select(
        F.concat(F.lit("p"), _s(F.col("p_partkey"))).alias("product_id"),
        F.concat(F.lit(" "), F.col("p_name")).alias("product_name"),
        F.lower(F.col("p_type")).alias("category"),
        F.concat(F.lit("size "), _s(F.col("p_size"))).alias("sub_category"),
        F.concat(F.lit(" "), F.col("p_brand"), F.lit(" ")).alias("brand"),
        _cents_to_text(cost_cents(cents)).alias("unit_cost"),
        _cents_to_text(cents).alias("unit_price"),
        F.concat(F.lit("sku-"), _s(F.col("p_partkey"))).alias("sku"),
        F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("s")).alias("supplier_id"),
        F.when(F.col("p_size") >= 10, F.lit("yes")).otherwise(F.lit("N")).alias("is_active"),
        F.date_format(created, "yyyy-MM-dd").alias("created_date"),
        (F.col("p_size") * F.lit(Decimal("0.125"))).cast("decimal(8,3)").cast("string").alias("weight_kg"),
        F.col("p_partkey").alias("_k"),
    )
    raw = _spoil(raw, "_k", BAD_PRODUCTS)
    assert tuple(raw.columns) == ERP_PRODUCTS.columns
    return add_audit_columns(raw, ERP_PRODUCTS.source_system, BATCH_ID, MASTER_INGESTED_AT)


def order_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem row; ``ingested_at`` is the ship time, so a
    repeated (order, line) pair is resolved to its latest version in Silver."""
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_linestatus", "l_shipdate")
    o = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "left")
    qty = F.col("l_quantity").cast("bigint")
    unit_cents = F.when(qty != 0, int_div(price_cents(F.col("l_extendedprice")), qty))
    raw = j.select(
        F.concat(F.lit(" o"), _s(F.col("l_orderkey"))).alias("order_id"),
        F.when((F.col("l_orderkey") % 199 == 0) & (F.col("l_linenumber") == 1), F.lit("  ")).otherwise(
            F.concat(F.lit("o"), _s(F.col("l_orderkey")), F.lit("-"), _s(F.col("l_linenumber")))).alias("order_line_id"),
        F.concat(F.lit("c"), _s(F.col("o_custkey"))).alias("customer_id"),
        F.concat(F.lit("p"), _s(F.col("l_partkey"))).alias("product_id"),
        F.when(F.col("l_orderkey") % 181 == 0, F.date_format(F.col("o_orderdate"), "yyyy/MM/dd"))
         .otherwise(F.date_format(F.col("o_orderdate"), "yyyy-MM-dd")).alias("order_date"),
        F.date_format(F.col("l_shipdate"), "yyyy-MM-dd").alias("ship_date"),
        _s(qty).alias("quantity"),
        _cents_to_text(unit_cents).alias("unit_price"),
        F.col("l_discount").cast("decimal(5,4)").cast("string").alias("discount_pct"),
        F.col("o_orderpriority").alias("payment_method"),
        F.lower(F.col("l_linestatus")).alias("order_channel"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("l_shipdate").alias("_ingested_at"),
        F.col("l_orderkey").alias("_k"),
    )
    raw = _spoil(raw, "_k", BAD_ORDERS)
    assert tuple(raw.columns[:-1]) == ECOM_ORDERS.columns
    out = add_audit_columns(raw, ECOM_ORDERS.source_system, BATCH_ID, F.col("_ingested_at"))
    return out.drop("_ingested_at")
