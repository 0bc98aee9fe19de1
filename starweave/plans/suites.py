"""The warehouse's data-quality suites, one aggregate pass per table."""
from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.quality import DuplicateRate, NullRate, RegexMatch, RowCount, ValueRange, foreign_keys, run_checks

# The checked columns and bounds of each suite.
SILVER_CUSTOMER_CHECKS = (RowCount(), NullRate(("customer_id", "email", "full_name", "country")),
                          DuplicateRate(("customer_id",)))
SILVER_PRODUCT_CHECKS = (RowCount(), NullRate(("product_id", "product_name", "unit_price")),
                         DuplicateRate(("product_id",)), ValueRange("unit_price", 0),
                         ValueRange("unit_cost", 0))
SILVER_ORDER_CHECKS = (RowCount(), NullRate(("order_id", "order_line_id", "customer_id", "product_id", "order_date")),
                       DuplicateRate(("order_line_id",)), ValueRange("quantity", 1),
                       ValueRange("unit_price", 0), ValueRange("net_revenue", 0))
FACT_CHECKS = (RowCount(), NullRate(("order_line_id", "customer_sk", "product_sk", "order_date_sk")),
               DuplicateRate(("order_line_id",)), ValueRange("quantity", 1),
               ValueRange("net_revenue", 0), ValueRange("gross_profit"))
CALENDAR_CHECKS = (RowCount(), DuplicateRate(("date_key",)))
# Regex checks (find-anywhere, NULL passes).
CONTACT_CHECKS = (RegexMatch("email", r"^[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}$"),
                  RegexMatch("phone", r"^\+?[0-9-]+$"))


def standard(df: DataFrame, table: str, not_null, keys) -> DataFrame:
    """Row count, NULL rate and duplicate rate (the suite run after each write)."""
    return run_checks(df, table, (RowCount(), NullRate(tuple(not_null)), DuplicateRate(tuple(keys))))


def dimension_checks(df: DataFrame, table: str, bk: str, sk: str) -> DataFrame:
    """Row count and duplicates on the business key; a second pass on the surrogate
    key fails at the first collision, which would fan the fact out."""
    return run_checks(df, table, (RowCount(), DuplicateRate((bk,)))).unionByName(
        run_checks(df, table + ":sk", (DuplicateRate((sk,), 0.0),)))


def fact_integrity(fact: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
                   dim_date: DataFrame, dim_geography: DataFrame, table: str = "fact_sales") -> DataFrame:
    pairs = [("customer_sk", dim_customer, "customer_sk"), ("product_sk", dim_product, "product_sk"),
             ("order_date_sk", dim_date, "date_key"), ("ship_date_sk", dim_date, "date_key"),
             ("geography_sk", dim_geography, "geography_sk")]
    return foreign_keys(fact, pairs, table)
