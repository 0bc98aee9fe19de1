"""Contracts of the three raw operational extracts.

Every raw column is a nullable string: typing happens in Silver, where a
failed parse is quarantined instead of failing the load.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StringType, StructField, StructType


@dataclass(frozen=True)
class Contract:
    name: str
    source_system: str
    columns: tuple
    key: tuple
    partition_by: tuple = field(default=())

    def schema(self) -> StructType:
        return StructType([StructField(c, StringType(), True) for c in self.columns])


# Extract names, source-system labels, column names and their
# order as the upstream systems deliver them.
CRM_CUSTOMERS = Contract(
    name="crm_customers",
    source_system="CRM_SYSTEM",
    columns=("customer_id", "first_name", "last_name", "email", "phone", "city",
             "state", "country", "zip_code", "customer_segment", "registration_date"),
    key=("customer_id",),
)
ERP_PRODUCTS = Contract(
    name="erp_products",
    source_system="ERP_SYSTEM",
    columns=("product_id", "product_name", "category", "sub_category", "brand",
             "unit_cost", "unit_price", "sku", "supplier_id", "is_active",
             "created_date", "weight_kg"),
    key=("product_id",),
)
ECOM_ORDERS = Contract(
    name="ecom_orders",
    source_system="ECOMMERCE_PLATFORM",
    columns=("order_id", "order_line_id", "customer_id", "product_id", "order_date",
             "ship_date", "quantity", "unit_price", "discount_pct", "payment_method",
             "order_channel", "order_status"),
    key=("order_line_id",),
    partition_by=("order_date",),
)

CONTRACTS = {c.name: c for c in (CRM_CUSTOMERS, ERP_PRODUCTS, ECOM_ORDERS)}
