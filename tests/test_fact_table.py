"""Repair of late and changed dimension members equals a rebuild, and touches only their partitions."""
import os

import pytest
from helpers import bronze, customer, order, product
from pyspark.sql import functions as F

from starweave.plans import dimensions
from starweave.plans.fact_table import Dimensions, FactTable
from starweave.plans.star import Star
from starweave.sources.contracts import CRM_CUSTOMERS, ECOM_ORDERS, ERP_PRODUCTS


@pytest.fixture
def star(spark):
    lines = [order("L1", od="2024-01-05", sd="2024-01-08"), order("L2", od="2024-01-06", cid="C002"),
             order("L3", od="2024-01-07", pid="P002"), order("L4", od="2024-01-07", cid="C009"),
             order("L5", od="2024-02-10", sd="2024-02-12"), order("L6", od=None, cid="C002"),
             order("L7", od="2024-01-09", sd="2024-02-11", cid="C003")]
    return Star(bronze(spark, CRM_CUSTOMERS, [customer("C001"), customer("C002", city="boston"), customer("C003", city="miami")]),
                bronze(spark, ERP_PRODUCTS, [product("P001"), product("P002", cost="20.00")]), bronze(spark, ECOM_ORDERS, lines),
                calendar=dimensions.dim_date(spark, "2024-01-01", "2024-02-29"))


def dims(s, customers="true", products="true", days="true", places="true", cost=None):
    p = s.dim_product.filter(products)
    if cost is not None:
        p = p.withColumn("unit_cost", F.lit(cost).cast(p.schema["unit_cost"].dataType))
    return Dimensions(s.dim_customer.filter(customers), p, s.dim_date.filter(days), s.dim_geography.filter(places))


def rows_of(df):
    return sorted(str(sorted((k, str(v)) for k, v in r.asDict().items() if not k.endswith("d_at"))) for r in df.collect())


def files(path):
    root = path.replace("file:", "")
    return {os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def folders(changed):
    return {os.path.basename(os.path.dirname(f)) for f in changed}


def test_late_members_mend_their_partitions_only(spark, scratch, star):
    table, full = FactTable(spark, scratch), dims(star)
    before = dims(star, customers="customer_bk <> 'C002'", products="product_bk <> 'P002'", days="month = 1")
    table.load(star.silver_orders, before)
    # Who waits: an unknown customer with a dated and an undated line, one that never comes, a product, a day twice.
    assert {(r.role, r.business_key, str(r.order_date)) for r in table.index().collect()} == {
        ("customer", "C002", "2024-01-06"), ("customer", "C002", "None"), ("customer", "C009", "2024-01-07"),
        ("product", "P002", "2024-01-07"), ("date", "2024-02-10", "2024-02-10"), ("date", "2024-02-12", "2024-02-10"),
        ("date", "2024-02-11", "2024-01-09")}
    old = files(table.rows_path)
    only_customer = dims(star, products="product_bk <> 'P002'", days="month = 1")
    assert table.repair(star.silver_orders, only_customer, before) == {"partitions": 2, "touched": 2}
    assert folders(old ^ files(table.rows_path)) == {"order_date=2024-01-06", "order_date=__HIVE_DEFAULT_PARTITION__"}
    assert table.repair(star.silver_orders, full, only_customer)["touched"] == 3
    assert rows_of(table.read()) == rows_of(full.fact(star.silver_orders))
    assert [(r.role, r.business_key) for r in table.index().collect()] == [("customer", "C009")]
    assert table.repair(star.silver_orders, full, full) == {"partitions": 0, "touched": 0}


def test_changed_members_are_carried_into_the_fact(spark, scratch, star):
    table, full = FactTable(spark, scratch), dims(star)
    before = dims(star, places="city <> 'Miami'", cost=1)
    table.load(star.silver_orders, before)
    place = dims(star, cost=1)
    assert table.repair(star.silver_orders, place, before) == {"partitions": 1, "touched": 1}  # C003's place has come
    assert table.repair(star.silver_orders, full, place)["touched"] == len({r.order_date for r in star.silver_orders.collect()})
    assert rows_of(table.read()) == rows_of(full.fact(star.silver_orders))


def test_an_interrupted_repair_is_finished_by_the_next(spark, scratch, star):
    """Late members are found by the index, whatever the dimensions before were."""
    table, full = FactTable(spark, scratch), dims(star)
    table.load(star.silver_orders, dims(star, customers="customer_bk = 'C001'"))
    keep = table._keep_index
    def dies(entries):
        raise RuntimeError("lost")
    table._keep_index = dies
    with pytest.raises(RuntimeError):
        table.repair(star.silver_orders, full)
    table._keep_index = keep
    table.repair(star.silver_orders, full)
    assert rows_of(table.read()) == rows_of(full.fact(star.silver_orders))
    first = table.index()
    table._keep_index(first.unionByName(spark.createDataFrame([("customer", "C002", None)], first.schema)))  # an entry left behind
    assert table.repair(star.silver_orders, full)["touched"] == 0 and table.index().count() == 1


def test_second_load_brings_lines_and_members(spark, scratch, star):
    table, full = FactTable(spark, scratch), dims(star)
    before = dims(star, customers="customer_bk = 'C001'")
    table.load(star.silver_orders.filter("order_line_id IN ('L1', 'L2')"), before)
    table.load(star.silver_orders.filter("order_line_id NOT IN ('L1')"), full)
    table.repair(star.silver_orders, full, before)
    assert rows_of(table.read()) == rows_of(full.fact(star.silver_orders))


def test_empty_tables(spark, scratch, star):
    table, full = FactTable(spark, scratch), dims(star)
    assert table.index().count() == 0
    table.load(star.silver_orders.filter("false"), full)
    assert table.read().count() == 0 and table.repair(star.silver_orders, full, full)["partitions"] == 0


def test_a_repair_neither_reads_silver_nor_shuffles_rows(spark, scratch, star, monkeypatch):
    """Few members that came or changed: the rows are met with them where they are, and written there."""
    from starweave.sources import tables
    table, full = FactTable(spark, scratch), dims(star)
    before = dims(star, customers="customer_bk <> 'C002'", products="product_bk <> 'P002'", days="month = 1", cost=1)
    staged, written, stage, write = [], [], tables.stage, tables.write
    monkeypatch.setattr(tables, "stage", lambda df, label="stage", *a, **k: (staged.append(label), stage(df, label, *a, **k))[1])
    monkeypatch.setattr(tables, "write", lambda df, path, *a, **k: (written.append((path, df, k)), write(df, path, *a, **k))[1])
    table.load(star.silver_orders, before)
    assert staged == []  # a first load writes its rows once
    def no_silver(*a, **k):
        raise AssertionError("Silver was read")
    monkeypatch.setattr(table, "_publish", no_silver)
    assert table.repair(star.silver_orders, full, before)["touched"] == 6
    path, df, how = next(w for w in reversed(written) if w[0] == table.rows_path)
    assert how["spread"] is False and "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
    assert not {"fact_rows", "held", "merged"} & set(staged)
    assert rows_of(table.read()) == rows_of(full.fact(star.silver_orders))


def test_many_members_are_shuffled_and_give_the_same(spark, scratch, star, monkeypatch):
    from starweave.plans import fact_table
    monkeypatch.setattr(fact_table, "FEW_MEMBERS", 0)
    table, full = FactTable(spark, scratch), dims(star)
    before = dims(star, customers="customer_bk <> 'C002'", products="product_bk <> 'P002'", days="month = 1", cost=1)
    table.load(star.silver_orders, before)
    assert table.repair(star.silver_orders, full, before)["touched"] == 6
    assert rows_of(table.read()) == rows_of(full.fact(star.silver_orders))


def test_lost_partitions_and_tables_without_keys_are_mended_from_silver(spark, scratch, star):
    import shutil
    from starweave.plans import fact
    from starweave.sources import tables
    table, full = FactTable(spark, scratch), dims(star)
    before = dims(star, customers="customer_bk <> 'C002'")
    table.load(star.silver_orders, before)
    shutil.rmtree(f"{table.rows_path}/order_date=2024-01-06".replace("file:", ""))  # a commit that died between delete and rename
    assert table.repair(star.silver_orders, full, before) == {"partitions": 2, "touched": 2}
    assert rows_of(table.read()) == rows_of(full.fact(star.silver_orders))
    old = FactTable(spark, f"{scratch}/old")
    rows = before.fact(star.silver_orders, None, fact_table_keys())
    tables.publish_partitions(rows.select(*fact.FACT_COLUMNS), old.rows_path, ["order_line_id"], [], "order_date")
    from starweave.plans.fact_table import unresolved
    old._keep_index(unresolved(rows))
    assert old.repair(star.silver_orders, full, before) == {"partitions": 2, "touched": 2}
    assert rows_of(old.read()) == rows_of(full.fact(star.silver_orders))


def fact_table_keys():
    from starweave.plans.fact_table import CARRIED
    return CARRIED


def test_a_first_load_that_died_before_its_index(spark, scratch, star):
    table, full = FactTable(spark, scratch), dims(star)
    def dies(entries):
        raise RuntimeError("lost")
    keep, table._keep_index = table._keep_index, dies
    with pytest.raises(RuntimeError):
        table.load(star.silver_orders, dims(star, customers="customer_bk = 'C001'"))
    table._keep_index = keep
    assert {r.business_key for r in table.index().collect()} == {"C002", "C003", "C009"}
    table.repair(star.silver_orders, full)
    assert rows_of(table.read()) == rows_of(full.fact(star.silver_orders))
