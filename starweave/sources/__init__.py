"""Sources and sinks: extract contracts, CSV landing, Parquet tables, layout."""
from .contracts import Contract, CRM_CUSTOMERS, ERP_PRODUCTS, ECOM_ORDERS, CONTRACTS
from .csv import read_extract, CORRUPT_COLUMN
from .ingest import add_audit_columns, add_row_audit_columns, ingest, check_schema

__all__ = [
    "Contract", "CRM_CUSTOMERS", "ERP_PRODUCTS", "ECOM_ORDERS", "CONTRACTS",
    "read_extract", "CORRUPT_COLUMN", "add_audit_columns", "add_row_audit_columns",
    "ingest", "check_schema",
]
