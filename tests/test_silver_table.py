"""Silver by batches equals a rebuild from all of Bronze, and touches only the buckets of changed keys."""
import os

import pytest
from helpers import bronze, order

from starweave.plans import silver
from starweave.plans.silver_table import ORDERS, SilverTable
from starweave.sources.contracts import ECOM_ORDERS


def files(path):
    root = path.replace("file:", "")
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def rows_of(df):
    return sorted((str(sorted((k, str(v)) for k, v in r.asDict().items() if k not in ("created_at", "updated_at"))) for r in df.collect()))


def test_batches_in_any_order_equal_a_rebuild(spark, scratch):
    early, late = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
    batches = [
        bronze(spark, ECOM_ORDERS, [order("L1"), order("L2"), order("L3", qty="7"), order(None), order("  ", oid="O9")], early),
        bronze(spark, ECOM_ORDERS, [order("L2", qty="abc"), order("l3 ", qty="9"), order("L4"), order("L4", price="90.00")], late),
        bronze(spark, ECOM_ORDERS, [order("L1", qty="5"), order("L4", qty="1"), order("L5", oid=None)], early),  # late rows, a tie
    ]
    whole = batches[0].unionByName(batches[1]).unionByName(batches[2])
    expected = silver.orders(whole)
    for n, turn in enumerate([(0, 1, 2), (2, 1, 0), (1, 0, 2, 1)]):
        table = SilverTable(spark, f"{scratch}/{n}", ORDERS, whole.schema)
        for b in turn:
            table.load(batches[b], f"b{b}")
        got = table.split()
        assert rows_of(got.valid) == rows_of(expected.valid)
        assert rows_of(got.rejected) == rows_of(expected.rejected)
        assert "L2" not in {r.order_line_id for r in got.valid.collect()}  # its latest row is invalid


def test_only_buckets_of_changed_keys_are_written(spark, scratch):
    first = bronze(spark, ECOM_ORDERS, [order(f"L{i}") for i in range(200)])
    table = SilverTable(spark, scratch, ORDERS, first.schema, least_buckets=32)
    assert table.load(first, "b1") == 32
    before = files(f"{scratch}/latest")
    assert table.load(first, "b1") == 0 and files(f"{scratch}/latest") == before  # loaded before
    older = bronze(spark, ECOM_ORDERS, [order("L7", qty="8")], "2023-01-01 00:00:00")
    assert table.load(older, "b2") == 0 and files(f"{scratch}/latest") == before
    assert table.load(bronze(spark, ECOM_ORDERS, [order("L7", qty="9")], "2024-03-01 00:00:00"), "b3") == 1
    after = files(f"{scratch}/latest")
    assert len({os.path.dirname(f) for f in set(before) ^ set(after)}) == 1
    assert {r.quantity for r in table.split().valid.filter("order_line_id = 'L7'").collect()} == {9}
    table.latest.rebucket(64)
    assert table.split().valid.count() == 200 and table.load(first, "b1") == 0


@pytest.mark.parametrize("load", [False, True])
def test_empty_batches(spark, scratch, load):
    nothing = bronze(spark, ECOM_ORDERS, [])
    table = SilverTable(spark, scratch, ORDERS, nothing.schema)
    if load:
        assert table.load(nothing, "b1") == 0
    split = table.split()
    assert split.valid.count() == split.rejected.count() == 0
