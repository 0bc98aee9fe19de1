"""Bronze landing: raw columns plus audit columns, nothing else changed."""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from .contracts import Contract
from .csv import read_extract


def _ts(value) -> Column:
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value.cast("timestamp")
    return F.lit(value).cast("timestamp")


def add_audit_columns(df: DataFrame, source_system: str, batch_id: str,
                      ingested_at=None) -> DataFrame:
    """``ingested_at``, ``source_system``, ``batch_id``.

    ``ingested_at`` defaults to the query's start time (one value for the
    whole batch); pass a literal or a column to make runs reproducible.
    """
    return df.withColumns({
        "ingested_at": _ts(ingested_at),
        "source_system": F.lit(source_system),
        "batch_id": F.lit(batch_id),
    })


def add_row_audit_columns(df: DataFrame, now=None) -> DataFrame:
    ts = _ts(now)
    return df.withColumns({"created_at": ts, "updated_at": ts})


def new_batch_id(now: _dt.datetime | None = None) -> str:
    return (now or _dt.datetime.now(_dt.timezone.utc)).strftime("%Y%m%d%H%M%S")


def ingest(spark: SparkSession, path: str, contract: Contract, batch_id: str | None = None,
           ingested_at=None, check_header: bool = True) -> DataFrame:
    """Read one raw extract and stamp it for Bronze (append it with ``tables.append``)."""
    raw = read_extract(spark, path, contract, check_header=check_header)
    return add_audit_columns(raw, contract.source_system, batch_id or new_batch_id(), ingested_at)


def check_schema(df: DataFrame, expected: StructType, check_types: bool = True) -> None:
    """Raise ``ValueError`` on missing columns, and on type drift if asked."""
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in expected.fields if f.name not in have]
    if missing:
        raise ValueError(f"schema check failed, missing columns: {missing}")
    if check_types:
        drift = [(f.name, have[f.name].simpleString(), f.dataType.simpleString())
                 for f in expected.fields if have[f.name] != f.dataType]
        if drift:
            raise ValueError(f"schema check failed, type drift (column, found, expected): {drift}")
