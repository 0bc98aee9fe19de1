"""Left lookups of dimension attributes.

Only the key and the wanted attributes of a dimension are read. No side is
hinted: Spark broadcasts a dimension whose statistics prove it small enough
(``spark.sql.autoBroadcastJoinThreshold``), at planning or, with adaptive
execution, once its shuffle shows the size; otherwise the join is shuffled and
skewed partitions are split at run time.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def lookup(fact: DataFrame, dim: DataFrame, fact_keys, dim_keys, columns: dict) -> DataFrame:
    """Left-join ``dim`` and add ``columns`` ({new_name: dim_column}).

    Unmatched fact rows are kept with NULLs. A dimension with a repeated
    key would fan the fact out, so dimensions are built one row per key.
    """
    fact_keys = [fact_keys] if isinstance(fact_keys, str) else list(fact_keys)
    dim_keys = [dim_keys] if isinstance(dim_keys, str) else list(dim_keys)
    side = dim.select(*[F.col(k).alias(f"__lk{i}") for i, k in enumerate(dim_keys)],
                      *[F.col(src).alias(dst) for dst, src in columns.items()])
    cond = [F.col(fk) == side[f"__lk{i}"] for i, fk in enumerate(fact_keys)]
    out = fact.join(side, cond, "left")
    return out.drop(*[f"__lk{i}" for i in range(len(dim_keys))])
