"""End-to-end loads on small CSV extracts: first load, incremental load, streaming landing."""
import os

from pyspark.sql import functions as F

from starweave.plans.load import load_batch
from starweave.sources import tables
from starweave.sources.contracts import CRM_CUSTOMERS, ECOM_ORDERS, ERP_PRODUCTS
from starweave.streaming import land, stream_extract


def csv(path, contract, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(",".join(contract.columns) + "\n")
        for r in rows:
            f.write(",".join(r) + "\n")


CUST = [["C001", "ann", "lee", "ann@x.com", "555-1", "new york", "ny", "usa", "10001", "vip", "2024-01-01"],
        ["C002", "bob", "ray", "bob@x.com", "555-2", "austin", "tx", "usa", "73301", "standard", "2024-01-02"]]
PROD = [["P001", "laptop", "electronics", "computers", "acme", "600.00", "1000.00", "SKU1", "S1", "true",
         "2023-01-01", "2.000"],
        ["P002", "desk", "furniture", "office", "oak", "100.00", "250.00", "SKU2", "S2", "yes", "2023-01-01",
         "20.000"]]
ORD1 = [["O1", "L1", "C001", "P001", "2024-01-05", "2024-01-08", "1", "1000.00", "0.1000", "card", "web",
         "processing"],
        ["O2", "L2", "C002", "P002", "2024-01-06", "2024-01-09", "2", "250.00", "0.0000", "paypal", "mobile",
         "delivered"]]
ORD2 = [["O1", "L1", "C001", "P001", "2024-01-07", "2024-01-08", "1", "1000.00", "0.1000", "card", "web",
         "delivered"],
        ["O3", "L3", "C001", "P002", "2024-02-01", "2024-02-03", "1", "250.00", "0.0000", "card", "web",
         "shipped"]]


def test_two_loads(spark, scratch, tmp_path):
    root = scratch
    d = str(tmp_path)
    csv(f"{d}/1/c.csv", CRM_CUSTOMERS, CUST)
    csv(f"{d}/1/p.csv", ERP_PRODUCTS, PROD)
    csv(f"{d}/1/o.csv", ECOM_ORDERS, ORD1)
    r1 = load_batch(spark, root, {"crm_customers": f"{d}/1/c.csv", "erp_products": f"{d}/1/p.csv",
                                  "ecom_orders": f"{d}/1/o.csv"}, "b1", now="2024-03-01 00:00:00")
    assert r1.filter(~F.col("passed")).filter(~F.col("check_name").startswith("range")).count() == 0
    csv(f"{d}/2/o.csv", ECOM_ORDERS, ORD2)
    load_batch(spark, root, {"ecom_orders": f"{d}/2/o.csv"}, "b2", now="2024-03-02 00:00:00")
    f = {r.order_line_id: r for r in spark.read.parquet(f"{root}/warehouse/fact_sales").collect()}
    assert set(f) == {"L1", "L2", "L3"}
    assert f["L1"].order_status == "Delivered" and str(f["L1"].order_date) == "2024-01-07"  # moved partition
    assert str(f["L2"].updated_at) == "2024-03-01 00:00:00"  # untouched row keeps its stamp
    assert not os.path.exists(f"{root}/warehouse/fact_sales/order_date=2024-01-05".replace("file:", ""))
    store = tables.TableStore(spark, f"{root}/warehouse")
    assert store.versions("dim_customer") == [1, 2] and store.read("dim_customer").count() == 2
    audit = spark.read.parquet(f"{root}/audit/dq_results")
    assert {r.batch_id for r in audit.select("batch_id").distinct().collect()} == {"b1", "b2"}


def test_streaming_landing_exactly_once(spark, scratch, tmp_path):
    folder = str(tmp_path / "drop")
    csv(f"{folder}/a.csv", ECOM_ORDERS, ORD1)
    target, ckpt = f"{scratch}/bronze", f"{scratch}/_ckpt"
    land(stream_extract(spark, folder, ECOM_ORDERS, "s1"), target, ckpt).awaitTermination()
    assert spark.read.parquet(target).count() == 2
    csv(f"{folder}/b.csv", ECOM_ORDERS, ORD2)
    land(stream_extract(spark, folder, ECOM_ORDERS, "s1"), target, ckpt).awaitTermination()
    assert spark.read.parquet(target).count() == 4  # only the new file was added
