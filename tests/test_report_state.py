"""Reports from per-day sums equal reports over the fact, after publishes that add, change, move and date lines."""
import os

from helpers import bronze, customer, order, product
from pyspark.sql import functions as F

from starweave.plans import dimensions, reports
from starweave.plans.fact_table import Dimensions, FactTable
from starweave.plans.report_state import ReportState
from starweave.plans.star import Star
from starweave.sources.contracts import CRM_CUSTOMERS, ECOM_ORDERS, ERP_PRODUCTS


def star(spark, lines):
    return Star(bronze(spark, CRM_CUSTOMERS, [customer("C001"), customer("C002", segment="standard")]),
                bronze(spark, ERP_PRODUCTS, [product("P001"), product("P002", name="desk", category="furniture")]),
                bronze(spark, ECOM_ORDERS, lines), calendar=dimensions.dim_date(spark, "2024-01-01", "2024-12-31"))


def rows(df):
    return sorted(map(str, df.collect()))


def same(state, fact, s):
    for name, dims in (("by_status", ()), ("by_channel", ()), ("by_category", (s.dim_product,)), ("by_segment", (s.dim_customer,)),
                       ("by_month", (s.dim_date,)), ("top_products", (s.dim_product,))):
        assert rows(getattr(state, name)(*dims)) == rows(getattr(reports, name)(fact, *dims)), name


def month_files(path):
    root = path.replace("file:", "")
    return {os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def test_state_follows_the_publishes(spark, scratch):
    first = [order("L1", oid="O1"), order("L2", oid="O1", od="2024-01-06", pid="P002"), order("L3", oid="O2", cid="C002", od="2024-02-01"),
             order("L4", oid="O3", od="2024-03-01", pid="P999"), order("L5", oid="O4", od=None, cid="C002"), order("L6", oid="O5", od="2024-05-05")]
    # L3 changes, L4 leaves March, a line of O1 on another day (one order), a line without a date; May stays as it is.
    second = [order("L3", oid="O2", cid="C002", od="2024-02-01", qty="9"), order("L4", oid="O3", od="2024-01-06", pid="P001"),
              order("L7", oid="O1", od="2024-02-01", channel="store"), order("L8", oid="O4", od=None, cid="C002")]
    s = star(spark, first)
    dims = Dimensions(s.dim_customer, s.dim_product, s.dim_date, s.dim_geography)
    table, state = FactTable(spark, f"{scratch}/fact"), ReportState(spark, f"{scratch}/state")
    assert table.load(s.silver_orders, dims)["values"] is None
    state.build(table.read())
    same(state, table.read(), s)
    before = month_files(state.path)
    info = table.load(star(spark, second).silver_orders, dims)
    assert state.update(table.read(), info["values"]) == 4  # January, February, March, no date
    same(state, table.read(), s)
    changed = {os.path.basename(os.path.dirname(f)) for f in before ^ month_files(state.path)}
    assert changed == {"month=2024-01", "month=2024-02", "month=2024-03", "month=none"}
    assert not any("2024-03" in f for f in month_files(state.path))  # nothing is left there
    state.update(table.read(), info["values"])  # a repeat changes nothing
    same(state, table.read(), s)
    assert state.update(table.read(), []) == 0


def test_empty_fact(spark, scratch):
    s = star(spark, [order("L1")])
    state = ReportState(spark, scratch)
    state.build(s.fact_sales.filter(F.lit(False)))
    same(state, s.fact_sales.filter(F.lit(False)), s)
