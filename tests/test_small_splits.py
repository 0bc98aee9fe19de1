"""What a task reads and carries while layers are written: small splits, no derived columns in the de-duplication."""
import re
import threading

from helpers import bronze, order

from starweave.plans import silver
from starweave.sources import tables
from starweave.sources.contracts import ECOM_ORDERS

CONF = "spark.sql.files.maxPartitionBytes"


def parts(spark, folder):
    return spark.read.parquet(folder).select("f").distinct().count()


def test_a_write_reads_small_splits_and_leaves_the_session_alone(spark, scratch, monkeypatch):
    from pyspark.sql import functions as F
    before = spark.conf.get(CONF)
    for i in range(6):
        spark.range(20_000).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    size = sum(s.getLen() for s in tables._fs(spark, scratch)[0].listStatus(tables._fs(spark, f"{scratch}/in")[1]))
    monkeypatch.setattr(tables, "SPLIT_BYTES", size // 6 + 1)
    old = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = spark.read.parquet(f"{scratch}/in").withColumn("f", F.spark_partition_id())
        assert tables.write(rows, f"{scratch}/out") == 120_000
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", old)
    assert parts(spark, f"{scratch}/out") >= 6
    assert spark.conf.get(CONF) == before


def test_the_last_of_several_writers_puts_the_setting_back(spark):
    before, inside, go = spark.conf.get(CONF), threading.Event(), threading.Event()

    def hold():
        with tables.small_splits(spark):
            inside.set()
            go.wait(30)
    t = threading.Thread(target=hold)
    t.start()
    inside.wait(30)
    with tables.small_splits(spark):
        pass
    assert int(spark.conf.get(CONF)) == tables.SPLIT_BYTES
    go.set()
    t.join()
    assert spark.conf.get(CONF) == before


def test_a_smaller_setting_of_the_session_stays(spark):
    before = spark.conf.get(CONF)
    spark.conf.set(CONF, "1m")
    try:
        with tables.small_splits(spark):
            assert spark.conf.get(CONF) == "1m"
        assert spark.conf.get(CONF) == "1m"
    finally:
        spark.conf.set(CONF, before)


def test_measures_are_derived_after_the_shuffle(spark):
    tagged = silver.tag_orders(bronze(spark, ECOM_ORDERS, [order("L1")]))
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("Exchange hashpartitioning")]
    below = plan[plan.index("Exchange hashpartitioning"):]
    below = below[:below.index("\n   +- ")] if "\n   +- " in below else below
    assert "AS net_revenue" in above and not re.search(r"AS (net_revenue|gross_revenue)", below)
