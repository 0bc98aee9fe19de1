"""One warehouse load: raw extracts → Bronze → Silver → Gold → checks.

``load_batch`` runs the whole sequence against versioned Parquet tables
under one root folder:

* Bronze: each extract is appended with audit columns (a rerun appends
  again; Silver's de-duplication absorbs it);
* Silver: rebuilt from all Bronze history (latest row per key); valid and
  quarantined rows are staged once and committed as two tables;
* dimensions: Type 1 upsert of the new staging into the current version
  (first load creates it), with keys that stay unique when hashes collide; the
  calendar is created once;
* fact: built from Silver orders and the new dimension versions, then
  published into the ``order_date`` partitions it touches;
* layout (``cluster=True``): each new dimension version is z-ordered on its
  lookup columns and fact files are sorted by their keys inside each
  partition, for tight Parquet min/max statistics;
* checks: each table's suite runs on the staged frame before the table is
  written (one pass per table). The results are appended to an audit table
  first; with ``enforce=True`` the load then stops at a failed check, before the
  tables of that layer are touched. Row counts of all tables close the load.
* staged folders are dropped, and all but the last two versions of every table.

Returns the check results of this load as a DataFrame.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from ..operators.quality import enforce as enforce_checks, row_counts, run_checks
from ..operators.surrogate import with_unique_keys
from ..sources import tables
from ..sources.contracts import CRM_CUSTOMERS, ECOM_ORDERS, ERP_PRODUCTS, Contract
from ..sources.csv import CORRUPT_COLUMN
from ..sources.ingest import check_schema, ingest
from . import dimensions, fact, silver, suites

# The calendar range of the warehouse, and the columns each
# table is clustered on after it is written.
CALENDAR_START = "2020-01-01"
CALENDAR_END = "2030-12-31"
CLUSTER_COLUMNS = {
    "dim_customer": ["customer_bk"],
    "dim_product": ["product_bk", "category"],
    "dim_date": ["date_key"],
    "dim_geography": ["country", "state"],
    "fact_sales": ["customer_sk", "product_sk", "order_date_sk"],
}


def bronze_schema(contract: Contract) -> StructType:
    return StructType(contract.schema().fields + [
        StructField(CORRUPT_COLUMN, StringType(), True),
        StructField("ingested_at", TimestampType(), True),
        StructField("source_system", StringType(), True),
        StructField("batch_id", StringType(), True)])


def read_bronze(spark: SparkSession, root: str, contract: Contract) -> DataFrame:
    """All landed rows of an extract: batches, and what the stream landed beside them.

    Columns have the contract's types whatever the folder names look like;
    columns that later batches added come along.
    """
    schema = bronze_schema(contract)
    found = [tables.read(spark, f"{root}/{place}/{contract.name}", schema) for place in ("bronze", "bronze_stream")
             if tables.exists(spark, f"{root}/{place}/{contract.name}")]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def stream_target(root: str, contract: Contract) -> str:
    """Where ``streaming.land`` puts an extract's stream. It has a folder of its own: the streaming sink keeps
    a log there, and Spark then reads only the files of that log."""
    return f"{root}/bronze_stream/{contract.name}"


def load_batch(spark: SparkSession, root: str, sources: dict, batch_id: str, now=None,
               calendar=(CALENDAR_START, CALENDAR_END), enforce: bool = False, cluster: bool = True) -> DataFrame:
    """``sources`` maps extract name (crm_customers / erp_products / ecom_orders) to a CSV path."""
    store = tables.TableStore(spark, f"{root}/warehouse")
    contracts = {c.name: c for c in (CRM_CUSTOMERS, ERP_PRODUCTS, ECOM_ORDERS)}
    staged: list = []
    audit = f"{root}/audit/dq_results"

    def gate(results: DataFrame) -> DataFrame:
        """Keep the results, then stop the load if one of them failed."""
        kept = tables.stage(results.withColumn("batch_id", F.lit(batch_id)), "checks", track=staged)
        tables.append(kept, audit)
        if enforce:
            enforce_checks(kept)
        return kept

    try:
        # Bronze
        for name, path in sources.items():
            c = contracts[name]
            landed = ingest(spark, path, c, batch_id, now)
            check_schema(landed, bronze_schema(c))
            tables.append(landed, f"{root}/bronze/{name}", partition_by=c.partition_by, cluster_by=c.key)

        # Silver: one staged pass per table, its checks, then the two outputs
        tagged = {
            "customers": (silver.tag_customers, CRM_CUSTOMERS, silver.CUSTOMER_COLUMNS, suites.SILVER_CUSTOMER_CHECKS),
            "products": (silver.tag_products, ERP_PRODUCTS, silver.PRODUCT_COLUMNS, suites.SILVER_PRODUCT_CHECKS),
            "orders": (silver.tag_orders, ECOM_ORDERS, silver.ORDER_COLUMNS, suites.SILVER_ORDER_CHECKS),
        }
        splits, results = {}, []
        for name, (tag, contract, columns, checks) in tagged.items():
            whole = tables.stage(tag(read_bronze(spark, root, contract)), f"silver_{name}", track=staged)
            splits[name] = silver.split_tagged(whole, columns, now)
            results.append(run_checks(splits[name].valid, f"silver_{name}", checks))
        done = [gate(_union(results))]
        for name, (_, contract, _, _) in tagged.items():
            store.commit(f"silver_{name}", splits[name].valid, partition_by=contract.partition_by, cluster_by=contract.key)
            store.commit(f"quarantine_{name}", splits[name].rejected)
        s_cust, s_prod, s_ord = (store.read(f"silver_{n}", splits[n].valid.schema) for n in ("customers", "products", "orders"))

        # Gold dimensions (Type 1)
        z = CLUSTER_COLUMNS if cluster else {}
        for name, dim, update in (("customer", dimensions.dim_customer(s_cust, now), dimensions.CUSTOMER_UPDATE_COLUMNS),
                                  ("product", dimensions.dim_product(s_prod, now), dimensions.PRODUCT_UPDATE_COLUMNS),
                                  ("geography", dimensions.dim_geography(s_cust, now), dimensions.GEOGRAPHY_UPDATE_COLUMNS)):
            table, bk = f"dim_{name}", f"{name}_bk"
            held = store.read(table) if store.exists(table) else None
            dim = with_unique_keys(dim, bk, f"{name}_sk", held, track=staged)
            store.merge(table, dim, bk, update, now, zorder_by=z.get(table, ()))
        if not store.exists("dim_date"):
            cal = dimensions.dim_date(spark, *calendar)
            store.commit("dim_date", cal.orderBy("date_key") if cluster else cal)
        d_cust, d_prod, d_geo, d_date = (store.read(n) for n in ("dim_customer", "dim_product", "dim_geography", "dim_date"))

        # Gold fact: staged, checked, then published into the partitions that change
        fact_path = f"{root}/warehouse/fact_sales"
        new_fact = tables.stage(fact.fact_sales(s_ord, d_cust, d_prod, d_date, d_geo, now), "fact", track=staged)
        done.append(gate(_union([
            suites.dimension_checks(d_cust, "dim_customer", "customer_bk", "customer_sk"),
            suites.dimension_checks(d_prod, "dim_product", "product_bk", "product_sk"),
            suites.dimension_checks(d_geo, "dim_geography", "geography_bk", "geography_sk"),
            run_checks(d_date, "dim_date", suites.CALENDAR_CHECKS),
            run_checks(new_fact, "fact_sales", suites.FACT_CHECKS),
            suites.fact_integrity(new_fact, d_cust, d_prod, d_date, d_geo)])))
        tables.publish_partitions(new_fact, fact_path, ["order_line_id"], fact.FACT_UPDATE_COLUMNS + ["updated_at"],
                                  "order_date", now, sort_by=z.get("fact_sales", ()), source_is_staged=True)

        # Row counts of all eleven tables
        rows = {("BRONZE", c.name): read_bronze(spark, root, c) for c in contracts.values()}
        rows |= {("SILVER", f"silver_{n}"): f for n, f in (("customers", s_cust), ("products", s_prod), ("orders", s_ord))}
        rows |= {("GOLD", "dim_customer"): d_cust, ("GOLD", "dim_product"): d_prod, ("GOLD", "dim_date"): d_date,
                 ("GOLD", "dim_geography"): d_geo, ("GOLD", "fact_sales"): tables.read(spark, fact_path, new_fact.schema)}
        done.append(gate(row_counts(rows).select(
            F.concat(F.lit("layer:"), "table_name").alias("table_name"), F.lit("row_count_check").alias("check_name"),
            F.col("row_count").alias("observed"), F.col("row_count").alias("total"),
            F.lit(None).cast("double").alias("threshold"), (F.col("row_count") > 0).alias("passed"))))
        for name in [f"{k}_{n}" for k in ("silver", "quarantine") for n in tagged] + ["dim_customer", "dim_product", "dim_geography"]:
            store.vacuum(name)
        rows = _union(done).collect()  # a few rows per check; the staged folders go below
        return spark.createDataFrame(rows, done[0].schema)
    finally:
        tables.drop_paths(spark, staged)


def _union(parts: list) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
