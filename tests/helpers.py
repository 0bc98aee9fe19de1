"""Build Bronze-shaped frames (all-string contract columns + audit columns)."""
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starweave.sources.contracts import Contract
from starweave.sources.ingest import add_audit_columns


def bronze(spark, contract: Contract, rows: list[dict], ingested_at="2024-01-01 00:00:00",
           batch_id="b1"):
    """Rows may carry ``_ts`` to land at their own time; others use ``ingested_at``."""
    cols = list(contract.columns) + ["_ts"]
    schema = StructType([StructField(c, StringType(), True) for c in cols])
    data = [tuple(r.get(c, ingested_at if c == "_ts" else None) for c in cols) for r in rows]
    df = spark.createDataFrame(data, schema)
    return add_audit_columns(df, contract.source_system, batch_id, F.col("_ts")).drop("_ts")


def customer(cid, email="a@b.com", first="ann", last="lee", city="new york", state="ny",
             country="usa", zip_code="10001", segment="vip", reg="2024-01-01", phone="555-0101"):
    return {"customer_id": cid, "first_name": first, "last_name": last, "email": email,
            "phone": phone, "city": city, "state": state, "country": country,
            "zip_code": zip_code, "customer_segment": segment, "registration_date": reg}


def product(pid, name="widget", cost="60.00", price="100.00", category="tools", active="true",
            weight="1.500", created="2023-05-01"):
    return {"product_id": pid, "product_name": name, "category": category, "sub_category": "misc",
            "brand": "acme", "unit_cost": cost, "unit_price": price, "sku": "sku-" + (pid or "x"),
            "supplier_id": "s1", "is_active": active, "created_date": created, "weight_kg": weight}


def order(line, oid="O1", cid="C001", pid="P001", od="2024-01-05", sd="2024-01-08", qty="2",
          price="100.00", disc="0.1000", pay="credit card", channel="web", status="delivered"):
    return {"order_id": oid, "order_line_id": line, "customer_id": cid, "product_id": pid,
            "order_date": od, "ship_date": sd, "quantity": qty, "unit_price": price,
            "discount_pct": disc, "payment_method": pay, "order_channel": channel,
            "order_status": status}
