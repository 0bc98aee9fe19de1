"""Second loads, odd partition values, interrupted publishes, evolving upserts, string clustering, gated loads."""
import os

import pytest
from helpers import bronze, customer, order, product
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starweave.operators.quality import CheckFailed
from starweave.operators.upsert import MERGE_ACTION, upsert
from starweave.plans import silver
from starweave.plans.load import load_batch, read_bronze, stream_target
from starweave.sources import tables
from starweave.sources.contracts import CRM_CUSTOMERS, ECOM_ORDERS, ERP_PRODUCTS
from starweave.sources.layout import zorder
from starweave.streaming import land, stream_extract


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path.replace("file:", "")) for f in fs if f.endswith(".parquet")}


def test_second_append_keeps_raw_partition_text(spark, scratch):
    path = f"{scratch}/bronze/ecom_orders"
    for rows in ([order("L1", od="2024-01-05")], [order("L2", od="2024/01/07"), order("L3", od="2024-1-6")]):
        tables.append(bronze(spark, ECOM_ORDERS, rows), path, partition_by=["order_date"])
    got = read_bronze(spark, scratch, ECOM_ORDERS)
    assert {r.order_line_id: r.order_date for r in got.collect()} == {"L1": "2024-01-05", "L2": "2024/01/07", "L3": "2024-1-6"}
    s = silver.orders(got)
    assert {r.order_line_id for r in s.valid.collect()} == {"L1"} and s.rejected.count() == 2


def test_evolved_columns_are_read_back(spark, scratch):
    p = f"{scratch}/t"
    tables.append(spark.createDataFrame([("a", "01")], "x string, p string"), p, partition_by=["p"])
    tables.append(spark.createDataFrame([("b", 1, "a:b")], "x string, y int, p string"), p, partition_by=["p"])
    assert {(r.x, r.y, r.p) for r in tables.read(spark, p).collect()} == {("a", None, "01"), ("b", 1, "a:b")}


def test_publish_string_partitions(spark, scratch):
    p, schema = f"{scratch}/f", "k string, part string, q int"
    tables.publish_partitions(spark.createDataFrame([("K1", "01", 1), ("K2", "a:b", 2), ("K3", None, 3), ("K4", "x=y", 4)], schema), p, "k", ["part", "q"], "part")
    info = tables.publish_partitions(spark.createDataFrame([("K1", "01", 10), ("K2", "02", 20), ("K3", "03", 30)], schema), p, "k", ["part", "q"], "part")
    out = tables.read(spark, p, spark.createDataFrame([], schema).schema)
    assert sorted((r.k, r.part, r.q) for r in out.collect()) == [("K1", "01", 10), ("K2", "02", 20), ("K3", "03", 30), ("K4", "x=y", 4)]
    assert set(info["emptied"]) == {"a:b", "None"}


def test_publish_of_unchanged_rows_touches_nothing(spark, scratch):
    p = f"{scratch}/f"
    first = spark.range(20).select("id", (F.col("id") % 4).cast("string").alias("d"), F.lit(1).alias("q"))
    tables.publish_partitions(first, p, "id", ["d", "q"], "d")
    before = files(p)
    assert tables.publish_partitions(first, p, "id", ["d", "q"], "d")["touched"] == 0
    assert files(p) == before
    change = first.filter("id = 1").withColumn("q", F.lit(2))
    assert tables.publish_partitions(change, p, "id", ["d", "q"], "d")["touched"] == 1
    after = files(p)
    assert {f for f in before if "/d=1/" not in f} == {f for f in after if "/d=1/" not in f}


def test_publish_filters_partitions_at_planning(spark, scratch):
    p = f"{scratch}/f"
    tables.publish_partitions(spark.range(20).select("id", (F.col("id") % 4).cast("string").alias("d")), p, "id", ["d"], "d")
    some = tables.read(spark, p).filter(tables._any_of("d", {"1", None}))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_publish_heals_an_interrupted_move(spark, scratch):
    p, schema = f"{scratch}/f", "k string, d string, q int, updated_at timestamp"
    row = lambda *r: spark.createDataFrame([r], "k string, d string, q int, u string").select("k", "d", "q", F.col("u").cast("timestamp").alias("updated_at"))
    tables.publish_partitions(row("K1", "a", 1, "2024-01-01 00:00:00"), p, "k", ["d", "q"], "d", now="2024-01-01 00:00:00")
    # The crash: the new partition is there, the emptied one not yet deleted.
    row("K1", "b", 2, "2024-01-02 00:00:00").write.mode("append").partitionBy("d").parquet(p)
    assert spark.read.parquet(p).count() == 2
    tables.publish_partitions(row("K1", "b", 2, "2024-01-02 00:00:00"), p, "k", ["d", "q"], "d", now="2024-01-03 00:00:00")
    assert [(r.k, r.d, r.q) for r in tables.read(spark, p).collect()] == [("K1", "b", 2)]


def test_half_written_first_load_is_no_table(spark, scratch):
    p = f"{scratch}/f"
    df = spark.createDataFrame([("K1", "a")], "k string, d string")
    df.write.partitionBy("d").parquet(p)
    os.remove(f"{p}/_SUCCESS".replace("file:", ""))
    assert tables.publish_partitions(df, p, "k", ["d"], "d")["created"]
    assert spark.read.parquet(p).count() == 1


def test_staged_folders_are_dropped(spark, scratch):
    root = tables.checkpoint_root(spark).replace("file:", "")
    before = set(os.listdir(root))
    for q in (1, 2):
        tables.publish_partitions(spark.range(3).select("id", F.lit("a").alias("d"), F.lit(q).alias("q")), f"{scratch}/f", "id", ["q"], "d")
    assert set(os.listdir(root)) - before <= {os.path.basename(scratch)}


def test_upsert_needs_its_update_columns(spark):
    t = spark.createDataFrame([("K1", 5)], "k string, q int")
    with pytest.raises(ValueError, match="missing from the source"):
        upsert(t, spark.createDataFrame([("K1",)], "k string"), "k", ["q"])


def test_upsert_fills_new_columns_of_matched_rows(spark):
    t = spark.createDataFrame([("K1", 5), ("K2", 6), ("K3", 7)], "k string, q int")
    s = spark.createDataFrame([("K1", 5, 7), ("K2", 6, None)], "k string, q int, n int")
    out = {r.k: (r.q, r.n, r[MERGE_ACTION]) for r in upsert(t, s, "k", ["q"], with_action=True).collect()}
    assert out == {"K1": (5, 7, "update"), "K2": (6, None, "noop"), "K3": (7, None, "keep")}


def test_upsert_reads_its_source_three_times_at_most(spark, scratch):
    spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("q")).write.parquet(f"{scratch}/s")
    spark.range(40).select(F.col("id").alias("k"), F.lit(0).alias("q")).write.parquet(f"{scratch}/t")
    out = upsert(spark.read.parquet(f"{scratch}/t"), spark.read.parquet(f"{scratch}/s"), "k", ["q"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"{scratch}/s]") <= 3
    assert out.agg(F.sum("q"), F.count("*")).first()[:] == (50, 50)


def test_upsert_repeated_source_key_raises_only_if_matched(spark):
    t = spark.createDataFrame([("K1", 1)], "k string, q int")
    again = spark.createDataFrame([("K2", 1), ("K2", 2), (None, 3), (None, 3)], "k string, q int")
    assert upsert(t, again, "k", ["q"]).count() == 5
    with pytest.raises(PySparkException, match="several source rows"):
        upsert(t, spark.createDataFrame([("K1", 1), ("K1", 2)], "k string, q int"), "k", ["q"]).collect()


def test_zorder_strings_with_a_common_prefix(spark):
    df = spark.range(4000).select(F.format_string("CUSTOMER-%07d", (F.col("id") * 7919) % 4000).alias("a"))
    out = zorder(df, ["a"], num_partitions=4)
    ranges = sorted((r.lo, r.hi) for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.min("a").alias("lo"), F.max("a").alias("hi")).collect())
    assert len(ranges) == 4 and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    mixed = spark.createDataFrame([("USA",), ("CANADA",), ("aa",), ("b",), ("",), (None,)], "a string")
    assert zorder(mixed, ["a"], num_partitions=1).collect()[1:] == [(x,) for x in ("", "CANADA", "USA", "aa", "b")]


def test_zorder_of_nothing(spark):
    assert zorder(spark.createDataFrame([], "a string, b int"), ["a", "b"]).count() == 0
    nulls = spark.createDataFrame([(None, 1), (None, 2)], "a string, b int")
    assert sorted(r.b for r in zorder(nulls, ["a", "b"]).collect()) == [1, 2]
    wide = spark.range(50).select(*[(F.col("id") * i).alias(f"c{i}") for i in range(1, 8)])
    assert zorder(wide, wide.columns).count() == 50


def csv(path, contract, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(",".join(contract.columns) + "\n")
        for r in rows:
            f.write(",".join("" if r[c] is None else r[c] for c in contract.columns) + "\n")


def sources(folder, orders_, state="ny"):
    csv(f"{folder}/c.csv", CRM_CUSTOMERS, [customer("C001", state=state)])
    csv(f"{folder}/p.csv", ERP_PRODUCTS, [product("P001")])
    csv(f"{folder}/o.csv", ECOM_ORDERS, orders_)
    return {"crm_customers": f"{folder}/c.csv", "erp_products": f"{folder}/p.csv", "ecom_orders": f"{folder}/o.csv"}


def test_failed_gate_leaves_the_fact_and_keeps_the_audit(spark, scratch, tmp_path):
    load_batch(spark, scratch, sources(f"{tmp_path}/1", [order("L1")], state=None), "b1", now="2024-03-01 00:00:00", enforce=True)
    fact = f"{scratch}/warehouse/fact_sales"
    before = files(fact)
    with pytest.raises(CheckFailed, match="ref_integrity_product_sk"):
        load_batch(spark, scratch, {"ecom_orders": sources(f"{tmp_path}/2", [order("L2", pid="P999")])["ecom_orders"]}, "b2",
                   now="2024-03-02 00:00:00", enforce=True)
    assert files(fact) == before
    audit = tables.read(spark, f"{scratch}/audit/dq_results").filter("batch_id = 'b2'")
    assert audit.filter("NOT passed").count() >= 1


def test_load_reports_eleven_counts_and_touches_only_new_days(spark, scratch, tmp_path):
    load_batch(spark, scratch, sources(f"{tmp_path}/1", [order("L1", od="2024-01-05"), order("L2", od="2024-01-06")]), "b1", now="2024-03-01 00:00:00")
    before = files(f"{scratch}/warehouse/fact_sales")
    r = load_batch(spark, scratch, {"ecom_orders": sources(f"{tmp_path}/2", [order("L3", od="2024-02-01")])["ecom_orders"]}, "b2", now="2024-03-02 00:00:00")
    counts = {x.table_name: x.observed for x in r.filter("table_name LIKE 'layer:%'").collect()}
    assert len(counts) == 11 and counts["layer:fact_sales"] == 3 and counts["layer:ecom_orders"] == 3
    after = files(f"{scratch}/warehouse/fact_sales")
    assert before.items() <= after.items()


def test_streamed_and_batch_bronze_are_both_read(spark, scratch, tmp_path):
    tables.append(bronze(spark, ECOM_ORDERS, [order("L1"), order("L2")]), f"{scratch}/bronze/ecom_orders", partition_by=["order_date"])
    csv(f"{tmp_path}/drop/a.csv", ECOM_ORDERS, [order("L3"), order("L4")])
    land(stream_extract(spark, f"{tmp_path}/drop", ECOM_ORDERS, "s1"), stream_target(scratch, ECOM_ORDERS), f"{scratch}/_ckpt").awaitTermination()
    assert {r.order_line_id for r in read_bronze(spark, scratch, ECOM_ORDERS).collect()} == {"L1", "L2", "L3", "L4"}
