"""Dimensions, calendar, fact lookups and reports on small fixtures."""
import datetime as dt
from decimal import Decimal

from helpers import bronze, customer, order, product
from starweave.plans import dimensions, reports
from starweave.plans.star import Star
from starweave.sources.contracts import CRM_CUSTOMERS, ECOM_ORDERS, ERP_PRODUCTS


def small_star(spark):
    cust = [customer("C001", segment="vip", zip_code="10001"),
            customer("C002", segment="standard", zip_code="10002"),   # same city, other zip
            customer("C003", segment="vip", city="austin", state=None, zip_code="73301")]
    prod = [product("P001", name="laptop", category="electronics", cost="600.00", price="1000.00"),
            product("P002", name="desk", category="furniture", cost="100.00", price="250.00")]
    ords = [order("L1", oid="O1", cid="C001", pid="P001", qty="1", price="1000.00", disc="0.1000"),
            order("L2", oid="O1", cid="C001", pid="P002", qty="2", price="250.00", disc="0.0000"),
            order("L3", oid="O2", cid="C002", pid="P001", qty="1", price="900.00", disc="0.0000",
                  status="shipped"),
            order("L4", oid="O3", cid="C003", pid="P999", qty="1", price="10.00", disc="0.0000"),
            order("L5", oid="O4", cid="C003", pid="P002", qty="1", price="250.00", disc="0.0000",
                  od="2024-02-10", sd="2031-01-01")]
    cal = dimensions.dim_date(spark, "2024-01-01", "2024-12-31")
    return Star(bronze(spark, CRM_CUSTOMERS, cust), bronze(spark, ERP_PRODUCTS, prod),
                bronze(spark, ECOM_ORDERS, ords), calendar=cal)


def test_dim_date_rows(spark):
    assert dimensions.dim_date(spark, "2020-01-01", "2030-12-31").count() == 4018


def test_dim_date_covering_whole_years(spark):
    df = spark.createDataFrame([(dt.date(1995, 3, 1), dt.date(1996, 2, 1))], "a date, b date")
    cal = dimensions.dim_date_covering(df, ["a", "b"])
    r = cal.agg({"full_date": "min"}).first()[0], cal.agg({"full_date": "max"}).first()[0]
    assert r == (dt.date(1995, 1, 1), dt.date(1996, 12, 31)) and cal.count() == 731


def test_geography_one_row_per_place(spark):
    s = small_star(spark)
    geo = {r.geography_bk: r for r in s.dim_geography.collect()}
    assert set(geo) == {"USA_NY_New York", "USA__Austin"}
    assert geo["USA_NY_New York"].zip_code == "10001"
    assert geo["USA_NY_New York"].geography_sk == 298392063268950640


def test_fact_grain_lookups_and_measures(spark):
    s = small_star(spark)
    f = {r.order_line_id: r for r in s.fact_sales.collect()}
    assert len(f) == 5  # one row per silver order line, no fan-out from two zips
    assert f["L1"].cogs == Decimal("600.00") and f["L1"].gross_profit == Decimal("300.00")
    assert f["L1"].gross_profit_pct == Decimal("33.33")
    assert f["L4"].product_sk is None and f["L4"].unit_cost is None  # unknown product kept
    assert f["L4"].geography_sk is not None  # NULL state still resolves
    assert f["L5"].ship_date_sk is None and f["L5"].order_date_sk == 20240210  # outside calendar
    assert f["L1"].order_date_sk == 20240105 and f["L1"].ship_date_sk == 20240108
    assert f["L1"].customer_sk == 741130920687010838


def test_fact_plans_without_a_job_or_a_forced_broadcast(spark):
    tracker = spark.sparkContext.statusTracker()
    group = "plan-only"
    spark.sparkContext.setJobGroup(group, group)
    try:
        plan = small_star(spark).fact_sales._jdf.queryExecution().analyzed().toString()
        assert not tracker.getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")
    assert "broadcast" not in plan.lower()


def test_reports(spark):
    s = small_star(spark)
    f = s.fact_sales
    cat = {r.category: r for r in reports.by_category(f, s.dim_product).collect()}
    assert cat["Electronics"].order_lines == 2 and cat["Electronics"].total_revenue == Decimal("1800.00")
    assert cat[None].order_lines == 1  # unmatched product forms the NULL group
    seg = {r.customer_segment: r for r in reports.by_segment(f, s.dim_customer).collect()}
    assert seg["VIP"].orders == 3 and seg["STANDARD"].orders == 1
    assert seg["VIP"].avg_order_value == Decimal("415.00")  # (900 + 500 + 10 + 250) / 4 lines
    top = reports.top_products(f, s.dim_product, n=1).collect()
    assert top[0].product_name == "Laptop"
    ch = reports.by_channel(f).collect()
    assert sum(r.orders for r in ch) == 5
    st = {r.order_status: r.orders for r in reports.by_status(f).collect()}
    assert st == {"Delivered": 4, "Shipped": 1}
    mon = {r.year_month: r.transactions for r in reports.by_month(f, s.dim_date).collect()}
    assert mon == {"2024-01": 4, "2024-02": 1}
