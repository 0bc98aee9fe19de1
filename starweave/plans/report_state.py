"""Sales reports kept up to date: partial sums by day, recomputed for touched days only.

A report is a sum over the days of the fact. The state keeps, for each ``order_date``, the
partial sums of every report's groups; counts, units and decimal sums merge exactly, means
come from merged sums and counts, and distinct orders from the keys of the orders of each
day. After a publish, only the days that it touched are read from the fact, in one pass for
all reports, and the months that hold them are rewritten; reports never read the fact.

The state is written in folders by month (days are rows), so a day costs no file of its own.
A month is replaced as a whole; an update that died is repeated as a whole, with the same days.
One writer at a time. Lines without a date are a day of their own.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources import tables
from . import reports

DAY, MONTH = "order_date", "month"
_KEYS = ["report", "k1", "k2", "sk"]
_SUMS = ("lines", "ids", "units", "net", "net_n", "profit", "pct_sum", "pct_n")


def _row(report: str, **values) -> Column:
    """What one line adds to one report: its group, and the measures that the report sums (NULL: none)."""
    types = {"k1": "string", "k2": "string", "sk": "long", "quantity": "int", "gross_profit": "decimal(18,2)",
             "net_revenue": "decimal(18,2)", "gross_profit_pct": "decimal(18,2)", "lines": "int", "ids": "int"}
    held = lambda c, kind: values[c].cast(kind) if c in values else F.lit(None).cast(kind)
    return F.struct(F.lit(report).alias("report"), *[held(c, kind).alias(c) for c, kind in types.items()])


def _lines(fact: DataFrame, *rows: Column) -> DataFrame:
    """A row for each line and report."""
    each = F.explode(F.array(*rows)) if len(rows) > 1 else F.array(*rows)[0]
    return fact.select(DAY, each.alias("g")).select(DAY, "g.*")


def _sum(rows: DataFrame) -> DataFrame:
    return rows.groupBy(DAY, *_KEYS).agg(
        F.count("lines").alias("lines"), F.count("ids").alias("ids"), F.sum("quantity").alias("units"), F.sum("net_revenue").alias("net"),
        F.count("net_revenue").alias("net_n"), F.sum("gross_profit").alias("profit"), F.sum("gross_profit_pct").alias("pct_sum"),
        F.count("gross_profit_pct").alias("pct_n"), F.count(F.lit(1)).alias("rows"))


def partial_sums(fact: DataFrame) -> DataFrame:
    """One row for each day, report and group, laid out for a write by month.

    Groups of few values (status, channel, day) are summed by the map tasks before they are shuffled. A product's
    or an order's lines of a day are few, so a sum before the shuffle saves nothing there: their rows, with the
    measures of their report only, are dealt once by ranges of (day, report, key), and are summed and written as
    they lie. A hot day is spread over tasks by the keys.
    """
    units, net, profit, pct = (F.col(c) for c in ("quantity", "net_revenue", "gross_profit", "gross_profit_pct"))
    lines, ids = (F.when(F.col(c).isNotNull(), F.lit(1)) for c in ("order_line_id", "order_id"))
    few = _sum(_lines(
        fact, _row("status", k1=F.col("order_status"), net_revenue=net, gross_profit=profit),
        _row("day", sk=F.col("order_date_sk"), lines=lines, net_revenue=net, gross_profit=profit),
        _row("channel", k1=F.col("order_channel"), k2=F.col("payment_method"), ids=ids, net_revenue=net)))
    many = _lines(fact, _row("product", sk=F.col("product_sk"), lines=lines, quantity=units, net_revenue=net, gross_profit=profit,
                             gross_profit_pct=pct),
                  _row("order", k1=F.col("order_id"), sk=F.col("customer_sk"), net_revenue=net))
    sums = _sum(many.repartitionByRange(DAY, "report", "sk", "k1")).unionByName(few.repartitionByRange(DAY))
    return sums.withColumn(MONTH, _month())


def _month() -> Column:
    return F.coalesce(F.date_format(DAY, "yyyy-MM"), F.lit("none"))


class ReportState:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def build(self, fact: DataFrame) -> None:
        """The state of a whole fact."""
        sums = partial_sums(fact)
        tables.write(sums, self.path, "overwrite", [MONTH], spread=False)
        tables.log_schema(self.spark, self.path, sums.schema)

    def update(self, fact: DataFrame, days) -> int:
        """Recompute ``days`` (values of ``order_date``) from ``fact``; the number of months written."""
        days = set(days)
        if not days:
            return 0
        months = sorted({d.strftime("%Y-%m") if d is not None else "none" for d in days})
        staged: list = []
        try:
            again = fact.filter(tables._any_of(DAY, days))
            held = tables.read(self.spark, self.path).filter(F.col(MONTH).isin(months))
            # Only what stays is staged (it is read from the months that are replaced); the touched days go straight there.
            stays = tables.stage(held.filter(~F.coalesce(tables._any_of(DAY, days), F.lit(False))), "report_months", track=staged)
            laid = stays.repartitionByRange(DAY, "report", "sk", "k1")
            tables.write(laid.unionByName(partial_sums(again)), self.path, "overwrite", [MONTH], dynamic=True, spread=False)
            left = {r[0] for r in stays.select(MONTH).union(again.select(_month())).distinct().collect()}
            fs, _ = tables._fs(self.spark, self.path)
            for month in set(months) - left:  # all lines of the month are gone
                fs.delete(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{MONTH}={month}"), True)
            return len(months)
        finally:
            tables.drop_paths(self.spark, staged)

    def _of(self, report: str) -> DataFrame:
        return tables.read(self.spark, self.path).filter(F.col("report") == report)

    def _merged(self, report: str, **names) -> DataFrame:
        """The sums of all days by group; ``names`` renames the group's columns."""
        return self._of(report).groupBy(*[F.col(k).alias(n) for k, n in names.items()]).agg(*[F.sum(c).alias(c) for c in (*_SUMS, "rows")])

    def _per_product(self) -> DataFrame:
        return self._merged("product", sk="product_sk").select(
            "product_sk", F.col("lines").alias("__lines"), F.col("units").alias("__units"), F.col("net").alias("__net"),
            F.col("profit").alias("__profit"), F.col("pct_sum").alias("__pct_sum"), F.col("pct_n").alias("__pct_n"))

    def by_status(self) -> DataFrame:
        return self._merged("status", k1="order_status").select(
            "order_status", F.col("rows").alias("orders"), reports._money(F.col("net")).alias("total_revenue"),
            reports._money(F.col("profit")).alias("total_gross_profit")).orderBy(F.desc("total_revenue"))

    def by_channel(self) -> DataFrame:
        return self._merged("channel", k1="order_channel", k2="payment_method").select(
            "order_channel", "payment_method", F.col("ids").alias("orders"), reports._money(F.col("net")).alias("revenue")).orderBy(F.desc("revenue"))

    def by_category(self, dim_product: DataFrame) -> DataFrame:
        return reports.category_of(self._per_product(), dim_product)

    def top_products(self, dim_product: DataFrame, n: int = 5) -> DataFrame:
        return reports.top_of(self._per_product(), dim_product, n)

    def by_segment(self, dim_customer: DataFrame) -> DataFrame:
        per_order = self._merged("order", sk="customer_sk", k1="order_id").select(
            "customer_sk", "order_id", F.col("net").alias("__net"), F.col("net_n").alias("__n"))
        return reports.segment_of(per_order, dim_customer)

    def by_month(self, dim_date: DataFrame) -> DataFrame:
        per_day = self._merged("day", sk="order_date_sk").select(
            "order_date_sk", F.col("lines").alias("__lines"), F.col("net").alias("__net"), F.col("profit").alias("__profit"))
        return reports.month_of(per_day, dim_date)
