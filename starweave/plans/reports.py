"""Sales reports over the fact.

Reports that need a dimension attribute first aggregate the fact by the
dimension key (partial aggregation in every map task, so the shuffle
carries one row per key and task, not the fact), then join the small
aggregate to the dimension and roll up to the attribute. The aggregate
comes out hash-partitioned on the key, so the join shuffles only the
dimension side. Sums and counts merge exactly, and means are computed
from them with ``exact_avg``, so the two-step result equals a
join-then-group over the raw fact.

Names of the reported measures follow the original reports (R0 and R5
count order *lines* as ``orders``; R2's ``avg_order_value`` is the mean
per line).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DecimalType

from ..functions.metrics import exact_avg

AMOUNT = DecimalType(38, 2)


def _money(c) -> "F.Column":
    return F.round(c, 2).cast(AMOUNT)


def by_status(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("order_status")
            .agg(F.count(F.lit(1)).alias("orders"),
                 _money(F.sum("net_revenue")).alias("total_revenue"),
                 _money(F.sum("gross_profit")).alias("total_gross_profit"))
            .orderBy(F.desc("total_revenue")))


def _per_product(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("product_sk")
            .agg(F.count("order_line_id").alias("__lines"),
                 F.sum("quantity").alias("__units"),
                 F.sum("net_revenue").alias("__net"),
                 F.sum("gross_profit").alias("__profit"),
                 F.sum("gross_profit_pct").alias("__pct_sum"),
                 F.count("gross_profit_pct").alias("__pct_n")))


def by_category(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    return category_of(_per_product(fact), dim_product)


def category_of(per_product: DataFrame, dim_product: DataFrame) -> DataFrame:
    j = per_product.join(dim_product.select("product_sk", "category"), "product_sk", "left")
    return (j.groupBy("category")
            .agg(F.sum("__lines").cast("bigint").alias("order_lines"),
                 F.sum("__units").cast("bigint").alias("total_units"),
                 _money(F.sum("__net")).alias("total_revenue"),
                 _money(F.sum("__profit")).alias("total_profit"),
                 exact_avg(F.sum("__pct_sum"), F.sum("__pct_n")).alias("avg_margin_pct"))
            .orderBy(F.desc("total_revenue")))


def by_segment(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    per_order = (fact.groupBy("customer_sk", "order_id")
                 .agg(F.sum("net_revenue").alias("__net"), F.count("net_revenue").alias("__n")))
    return segment_of(per_order, dim_customer)


def segment_of(per_order: DataFrame, dim_customer: DataFrame) -> DataFrame:
    j = per_order.join(dim_customer.select("customer_sk", "customer_segment"), "customer_sk", "left")
    return (j.groupBy("customer_segment")
            .agg(F.count_distinct("order_id").alias("orders"),
                 _money(F.sum("__net")).alias("total_revenue"),
                 exact_avg(F.sum("__net"), F.sum("__n")).alias("avg_order_value"))
            .orderBy(F.desc("total_revenue")))


def by_month(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    per_day = (fact.groupBy("order_date_sk")
               .agg(F.count("order_line_id").alias("__lines"),
                    F.sum("net_revenue").alias("__net"),
                    F.sum("gross_profit").alias("__profit")))
    return month_of(per_day, dim_date)


def month_of(per_day: DataFrame, dim_date: DataFrame) -> DataFrame:
    days = dim_date.select(F.col("date_key").alias("order_date_sk"), "year_month")
    j = per_day.join(days, "order_date_sk", "left")
    return (j.groupBy("year_month")
            .agg(F.sum("__lines").cast("bigint").alias("transactions"),
                 _money(F.sum("__net")).alias("monthly_revenue"),
                 _money(F.sum("__profit")).alias("monthly_profit"))
            .orderBy("year_month"))


def top_products(fact: DataFrame, dim_product: DataFrame, n: int = 5) -> DataFrame:
    return top_of(_per_product(fact), dim_product, n)


def top_of(per_product: DataFrame, dim_product: DataFrame, n: int) -> DataFrame:
    j = per_product.join(dim_product.select("product_sk", "product_name", "category"),
                                "product_sk", "left")
    return (j.groupBy("product_name", "category")
            .agg(F.sum("__units").cast("bigint").alias("units_sold"),
                 _money(F.sum("__net")).alias("total_revenue"),
                 exact_avg(F.sum("__pct_sum"), F.sum("__pct_n")).alias("avg_margin_pct"))
            .orderBy(F.desc("total_revenue"), F.asc("product_name"), F.asc("category"))
            .limit(n))


def by_channel(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("order_channel", "payment_method")
            .agg(F.count("order_id").alias("orders"),
                 _money(F.sum("net_revenue")).alias("revenue"))
            .orderBy(F.desc("revenue")))
