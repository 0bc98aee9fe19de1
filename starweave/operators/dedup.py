"""Keep the latest row per business key.

``row_number() over (partition by key order by ts desc, <tie-break>) = 1``.
Catalyst turns the ``= 1`` filter into a partial ``WindowGroupLimit``
before the shuffle and a final one after it, so each map task forwards at
most one row per key: a hot key holding a third of the table costs one row
per map partition in the shuffle, not a third of the table in one task.

The tie-break orders by every other column (ascending, NULLs first), so
rows landed with the same timestamp resolve to the same winner on every
run and every partitioning.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def keep_latest(df: DataFrame, keys, order_col: str = "ingested_at",
                tiebreak: list | None = None) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    if tiebreak is None:
        visible = [c for c in df.columns if c not in keys and c != order_col and not c.startswith("_")]
        hidden = [c for c in df.columns if c not in keys and c != order_col and c.startswith("_")]
        tiebreak = visible + hidden
    order: list[Column] = [F.col(order_col).desc_nulls_last()]
    order += [(F.col(c) if isinstance(c, str) else c).asc_nulls_first() for c in tiebreak]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")
