"""Staged and shuffled rows hold no raw text and no amount that follows from the values beside it; readers see whole rows."""
import itertools

from helpers import bronze, customer, order, product

from starweave.plans import dimensions, silver
from starweave.plans.star import Star
from starweave.sources import tables
from starweave.sources.contracts import CRM_CUSTOMERS, ECOM_ORDERS, ERP_PRODUCTS

ROWS = [order("L1"), order("L2", qty="2.0", price=" 7.5"), order("L3", qty="abc", sd=None), order("L4", od="2024/01/05", disc="x"),
        order("L5", price="0"), order("L6", pid="P9", qty=None), order(" ", qty="x"), order("L7", qty="+3", disc=".25")]


def stars(spark):
    inputs = (bronze(spark, CRM_CUSTOMERS, [customer("C001"), customer("C2", reg="soon")]),
              bronze(spark, ERP_PRODUCTS, [product("P001", active="yes", cost="5"), product("P2", weight="heavy")]), bronze(spark, ECOM_ORDERS, ROWS))
    return [Star(*inputs, calendar=dimensions.dim_date(spark, "2024-01-01", "2024-12-31"), stage=stage) for stage in (False, True)]


def rows(df):
    return sorted(map(str, df.collect()))


def test_staged_layers_leave_out_what_follows_and_read_whole(spark, monkeypatch):
    held, plain = {}, tables.stage
    monkeypatch.setattr(tables, "stage", lambda df, label="stage", *a, **k: (held.update({label: plain(df, label, *a, **k)}), held[label])[1])
    lazy, staged = stars(spark)
    for name in ("silver_orders_tagged", "fact_sales"):
        a, b = getattr(lazy, name), getattr(staged, name)
        assert a.dtypes == b.dtypes and rows(a) == rows(b)
    for name in ("silver_customers_split", "silver_products_split", "silver_orders_split"):
        for a, b in zip(getattr(lazy, name), getattr(staged, name)):
            assert a.dtypes == b.dtypes and rows(a) == rows(b)
    amounts = {"gross_revenue", "net_revenue", "discount_amount"}
    assert not [c for label in ("silver_orders", "silver_customers", "silver_products") for c in held[label].columns if c.startswith("_raw_")]
    assert not (amounts | {"days_to_ship"}) & set(held["silver_orders"].columns)
    assert not (amounts | {"cogs", "gross_profit", "gross_profit_pct"}) & set(held["fact_sales"].columns)


def test_raw_texts_are_not_shuffled(spark):
    plan = silver.tag_orders(bronze(spark, ECOM_ORDERS, ROWS))._jdf.queryExecution().executedPlan().toString()
    exchange = plan[plan.index("Exchange hashpartitioning"):]
    below = next(line for line in exchange.splitlines() if "Project" in line or "WindowGroupLimit" in line or "Sort" in line)
    assert "_raw_" not in below and "Exchange" in plan
    assert "_raw_quantity" in plan[:plan.index("Exchange hashpartitioning")]


def test_rows_of_equal_values_are_still_chosen_by_their_raw_text(spark):
    spelled = ["2", " 2", "02", "+2", "2 "]
    prices = ["100.00", "100", "1e2"]
    ways = list(itertools.product(spelled, prices))
    for some in (ways, ways[::-1], [w for w in ways if w != min(ways)], [("2", "100.00"), ("2 ", "100")], [("2", "100.00"), (" 2", "1e2"), ("2", "100")]):
        tagged = silver.tag_orders(bronze(spark, ECOM_ORDERS, [order("L1", qty=q, price=p) for q, p in some]))
        [r] = tagged.collect()
        assert (r["_raw_quantity"], r["_raw_unit_price"]) == min(some)
        assert (r.quantity, str(r.unit_price), r.reject_reasons) == (2, "100.00", [])


def test_a_publish_merges_without_the_columns_that_follow(spark, scratch, monkeypatch):
    follow = lambda df: df.selectExpr("*", "q * price AS total")
    frame = lambda some: spark.createDataFrame(some, "k string, q int, price int, d string")
    first = frame([("K1", 1, 10, "a"), ("K2", 2, 10, "a"), ("K3", 3, 10, "b"), ("K4", 4, 10, None)])
    second = frame([("K1", 5, 10, "a"), ("K2", 2, 10, "a"), ("K3", 3, 10, "c"), ("K9", 9, 7, "a"), (None, 1, 1, "z")])
    held, plain = {}, tables.stage
    monkeypatch.setattr(tables, "stage", lambda df, label="stage", *a, **k: (held.setdefault(label, []).append(df.columns), plain(df, label, *a, **k))[1])
    got = {}
    for name, whole, made in (("with", follow, []), ("without", lambda df: df, ["total"])):
        infos = [tables.publish_partitions(df if whole is follow else follow(df), f"{scratch}/{name}", "k", ["q", "price", "d", *made], "d",
                                           follow=follow if whole is follow else None) for df in (first, second, second)]
        got[name] = rows(tables.read(spark, f"{scratch}/{name}", follow(first).schema).select("k", "q", "price", "total", "d")), infos
    assert got["with"] == got["without"]
    assert "Row(k='K1', q=5, price=10, total=50, d='a')" in got["with"][0] and "Row(k='K9', q=9, price=7, total=63, d='a')" in got["with"][0]
    assert got["with"][1][1]["emptied"] == ["b"]
    merged = held["merged"]
    assert len(merged) == 4 and ["total" in columns for columns in merged] == [False, False, True, True]
    assert set(tables.logged_schema(spark, f"{scratch}/with").names) == {"k", "q", "price", "total", "d"}
