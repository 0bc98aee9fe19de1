"""Steps that large runs showed to be dear: what they must not do any more, and that they still give the same."""
import importlib

from helpers import bronze, customer, order, product

from starweave.plans.silver_table import ORDERS, SilverTable
from starweave.sources import tables
from starweave.sources.contracts import ECOM_ORDERS


def test_a_silver_load_stages_rows_once_and_no_replaced_rows(spark, scratch, monkeypatch):
    staged, plain = [], tables.stage
    monkeypatch.setattr(tables, "stage", lambda df, label="stage", *a, **k: (staged.append(label), plain(df, label, *a, **k))[1])
    first = bronze(spark, ECOM_ORDERS, [order("L1"), order("L2")], "2024-01-01 00:00:00")
    second = bronze(spark, ECOM_ORDERS, [order("L2", qty="7"), order("L3")], "2024-02-01 00:00:00")
    table = SilverTable(spark, scratch, ORDERS, first.schema)
    table.load(first, "a")
    assert staged == ["silver_batch"]
    table.load(second, "b")
    assert staged == ["silver_batch", "silver_batch", "merged_rows"]
    assert sorted((r.order_line_id, r.quantity) for r in table.split().valid.collect()) == [("L1", 2), ("L2", 7), ("L3", 2)]


def test_a_merge_still_tells_what_it_replaced(spark, scratch):
    from starweave.sources.buckets import BucketTable
    df = lambda rows: spark.createDataFrame(rows, "k string, t int, v int")
    table = BucketTable(spark, scratch, "k", df([]).schema)
    one = table.merge(df([("a", 1, 1), ("b", 1, 1)]), "t", ["v"])
    assert [r["__before"] for r in one.changes.collect()] == [None, None] and one.after.count() == 2
    one.commit()
    two = table.merge(df([("a", 2, 5), ("b", 0, 9)]), "t", ["v"])
    assert [(r.k, r.v, r["__before"].v) for r in two.changes.collect()] == [("a", 5, 1)]


def test_an_upsert_shuffles_each_side_once(spark, monkeypatch):
    module = importlib.import_module("starweave.operators.upsert")  # the package has a function of that name
    target = spark.range(100).selectExpr("cast(id as string) k", "id v")
    source = spark.range(50, 150).selectExpr("cast(id as string) k", "id * 2 v")
    twice = source.unionByName(spark.sql("select 'new' k, 1L v union all select 'new', 2L"))
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    rows = lambda df: sorted(map(tuple, df.collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert exchanges(module.upsert(target, source, "k", ["v"], with_action=True)) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    few = rows(module.upsert(target, twice, "k", ["v"], with_action=True))
    monkeypatch.setattr(module, "FEW_REPEATED", 0)  # any repeated key is one too many for the plan
    assert rows(module.upsert(target, twice, "k", ["v"], with_action=True)) == few
    assert len(few) == 152 and ("new", 2, "insert") in few


def test_report_sums_deal_lines_once(spark, scratch, monkeypatch):
    from starweave.plans import report_state
    fact = spark.range(200).selectExpr(
        "date_add(date'2024-01-01', cast(id % 40 as int)) order_date", "cast(id as string) order_line_id", "cast(id % 50 as string) order_id",
        "cast(id % 3 as int) quantity", "cast(id as decimal(18,2)) net_revenue", "cast(1 as decimal(18,2)) gross_profit",
        "cast(2 as decimal(18,2)) gross_profit_pct", "'S' order_status", "id % 7 product_sk", "id % 5 customer_sk", "1 order_date_sk",
        "'web' order_channel", "'card' payment_method")
    plan = report_state.partial_sums(fact)._jdf.queryExecution().executedPlan().toString()
    # one deal of the lines; the summed rows of the small groups move twice
    assert plan.count("Exchange rangepartitioning") == 2 and plan.count("Exchange hashpartitioning") == 1
    staged, plain = [], tables.stage
    monkeypatch.setattr(tables, "stage", lambda df, label="stage", *a, **k: (staged.append(plain(df, label, *a, **k)), staged[-1])[1])
    held = []
    monkeypatch.setattr(tables, "drop_paths", lambda *a: held.extend(df.count() for df in staged))
    state = report_state.ReportState(spark, scratch)
    state.build(fact)
    state.update(fact, [r[0] for r in fact.select("order_date").distinct().collect()])
    assert held == [0]  # recomputed days are not staged before they are written
    assert [tuple(map(str, r)) for r in state.by_status().collect()] == [("S", "200", "19900.00", "200.00")]


def test_the_fact_shuffles_neither_measures_nor_date_keys(spark, monkeypatch):
    from starweave.plans import dimensions, fact
    from starweave.plans.star import Star
    from starweave.sources.contracts import CRM_CUSTOMERS, ERP_PRODUCTS
    joined = []
    for name in ("resolve_customers", "resolve_products"):
        plain = getattr(fact, name)
        monkeypatch.setattr(fact, name, lambda orders, dim, plain=plain: (joined.extend(orders.columns), plain(orders, dim))[1])
    s = Star(bronze(spark, CRM_CUSTOMERS, [customer("C001")]), bronze(spark, ERP_PRODUCTS, [product("P001")]),
             bronze(spark, ECOM_ORDERS, [order("L1"), order("L2", pid="P9", sd=None)]), calendar=dimensions.dim_date(spark, "2024-01-01", "2024-12-31"))
    got = {r.order_line_id: (str(r.net_revenue), str(r.gross_profit), r.days_to_ship, r.order_date_sk, r.ship_date_sk) for r in s.fact_sales.collect()}
    assert got == {"L1": ("180.00", "60.00", 3, 20240105, 20240108), "L2": ("180.00", "None", None, 20240105, None)}
    assert "order_line_id" in joined
    assert not {"discount_amount", "gross_revenue", "net_revenue", "days_to_ship", "order_date_sk", "ship_date_sk"} & set(joined)


def test_a_first_load_of_the_fact_is_dealt_without_measures(spark, scratch, monkeypatch):
    from starweave.plans import dimensions
    from starweave.plans.fact_table import Dimensions, FactTable
    from starweave.plans.star import Star
    from starweave.sources.contracts import CRM_CUSTOMERS, ERP_PRODUCTS
    s = Star(bronze(spark, CRM_CUSTOMERS, [customer("C001")]), bronze(spark, ERP_PRODUCTS, [product("P001")]),
             bronze(spark, ECOM_ORDERS, [order("L1"), order("L2", od="2024-01-06")]), calendar=dimensions.dim_date(spark, "2024-01-01", "2024-12-31"))
    written, plain = [], tables.write
    monkeypatch.setattr(tables, "write", lambda df, *a, **k: (written.append((df, k)), plain(df, *a, **k))[1])
    table = FactTable(spark, scratch)
    table.load(s.silver_orders, Dimensions(s.dim_customer, s.dim_product, s.dim_date, s.dim_geography))
    df, how = written[0]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert how["spread"] is False and plan.count("Exchange rangepartitioning") == 1
    below = plan[plan.index("Exchange rangepartitioning"):]
    assert "AS gross_profit" in plan and "AS gross_profit" not in below and "AS net_revenue" not in below
    assert sorted((r.order_line_id, str(r.gross_profit)) for r in table.read().collect()) == [("L1", "60.00"), ("L2", "60.00")]


def test_partition_publish_needs_no_deduplication_of_both_loads(spark, monkeypatch):
    import __spark_entry__ as entry
    from starweave.plans.star import Star
    def whole(self):
        raise AssertionError("both loads were de-duplicated together")
    monkeypatch.setattr(Star, "silver_orders_tagged", property(whole))
    monkeypatch.setattr(entry, "_STARS", {})
    monkeypatch.setattr(entry, "_BATCHES", {})
    monkeypatch.setattr(tables, "publish_partitions", lambda *a, **k: {})
    monkeypatch.setattr(spark.read.__class__, "parquet", (lambda plain: lambda self, *p, **k: plain(self, *p, **k) if "fact_sales-" not in p[0] else p[0])(spark.read.__class__.parquet))
    assert "fact_sales-" in entry.queries()["partition_publish"](spark, "/root/testdata/sf0.001")
