"""Gold fact: one row per order line with dimension keys and measures.

Lookups (all left joins, unmatched keys stay NULL and the row is kept):

* order and ship date → ``date_key``: one calendar, used twice (role playing);
* customer → ``customer_sk`` and ``geography_sk``: the geography key is
  resolved on the customer dimension first (dimension-sized join), so the
  fact needs one customer lookup, not two;
* product → ``product_sk`` and the current ``unit_cost``.

Spark broadcasts a dimension whose statistics prove it small; a larger one is
joined by shuffle.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import metrics
from ..operators.lookup import lookup
from ..sources.ingest import _ts
from .dimensions import geography_bk
from .silver import ORDER_MEASURES, order_amounts, with_order_measures

# Fixed value: the contract of the fact table.
FACT_COLUMNS = [
    "customer_sk", "product_sk", "order_date_sk", "ship_date_sk", "geography_sk",
    "order_id", "order_line_id", "payment_method", "order_channel", "order_status",
    "quantity", "unit_price", "unit_cost", "discount_pct", "discount_amount", "gross_revenue",
    "net_revenue", "cogs", "gross_profit", "gross_profit_pct", "days_to_ship",
    "order_date", "source_system", "batch_id", "created_at", "updated_at"]

# What a later load may change: all but the line's own ids and the audit columns.
FACT_UPDATE_COLUMNS = [c for c in FACT_COLUMNS if c not in (
    "order_id", "order_line_id", "source_system", "batch_id", "created_at", "updated_at")]


def customer_keys(dim_customer: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """customer_bk → customer_sk, geography_sk (resolved on the dimension side)."""
    cust = dim_customer.select("customer_bk", "customer_sk",
                               geography_bk().alias("__geo_bk"))
    cust = lookup(cust, dim_geography, "__geo_bk", "geography_bk",
                  {"geography_sk": "geography_sk"})
    return cust.drop("__geo_bk")


def resolve_dates(orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    f = lookup(orders, dim_date, "order_date", "full_date", {"order_date_sk": "date_key"})
    return lookup(f, dim_date, "ship_date", "full_date", {"ship_date_sk": "date_key"})


def resolve_customers(orders: DataFrame, cust_keys: DataFrame) -> DataFrame:
    return lookup(orders, cust_keys, "customer_id", "customer_bk",
                  {"customer_sk": "customer_sk", "geography_sk": "geography_sk"})


def resolve_products(orders: DataFrame, dim_product: DataFrame) -> DataFrame:
    return lookup(orders, dim_product, "product_id", "product_bk",
                  {"product_sk": "product_sk", "unit_cost": "unit_cost"})


def with_measures(f: DataFrame) -> DataFrame:
    cogs = metrics.cogs("quantity", "unit_cost")
    profit = metrics.gross_profit("net_revenue", cogs)
    return f.withColumns({
        "cogs": cogs,
        "gross_profit": profit,
        "gross_profit_pct": metrics.gross_profit_pct(profit, "net_revenue"),
    })


# Amounts that follow from a fact row's quantity, prices and discount.
AMOUNTS = ["discount_amount", "gross_revenue", "net_revenue", "cogs", "gross_profit", "gross_profit_pct"]


def packed(rows: DataFrame) -> DataFrame:
    """Fact rows as they are staged: without the amounts, which ``unpacked`` makes again."""
    return rows.drop(*AMOUNTS)


def unpacked(rows: DataFrame) -> DataFrame:
    whole = with_measures(rows.withColumns(order_amounts()))
    return whole.select(*[c for c in FACT_COLUMNS if c in whole.columns], *[c for c in rows.columns if c not in FACT_COLUMNS])


def fact_sales(orders: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
               dim_date: DataFrame, dim_geography: DataFrame, now=None, keep=(), lay_by=()) -> DataFrame:
    """The fact rows of ``orders`` (valid rows of Silver); ``keep`` names order columns to carry along (see ``fact_table``).

    ``lay_by`` names columns whose ranges the rows are dealt by, for a partitioned write (``tables.publish_partitions``
    with ``laid``): that shuffle carries no measures either.
    """
    # Silver's amounts and days follow from a line's other columns: they are made again behind the shuffles.
    f = orders.drop("created_at", "updated_at", *ORDER_MEASURES)
    f = resolve_customers(f, customer_keys(dim_customer, dim_geography))
    f = resolve_products(f, dim_product)
    f = resolve_dates(f, dim_date)  # broadcast: after the shuffles, which need not carry its keys
    if lay_by:
        f = f.repartitionByRange(*lay_by)
    f = with_measures(with_order_measures(f))
    ts = _ts(now)
    return f.withColumns({"created_at": ts, "updated_at": ts}).select(*FACT_COLUMNS, *keep)
