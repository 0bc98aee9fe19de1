"""Slowly changing dimension, Type 1: upsert a source batch into a target.

Plain Parquet has no MERGE, so the merge is a full outer join on the keys
that produces the next version of the table (write it to a new location,
see ``sources.tables``):

* matched, some update column changed → update columns from the source,
  ``updated_at`` = ``now``; every other column keeps the target value;
* matched, nothing changed and ``only_changed`` → the target row as is;
* source only (incl. NULL keys, which never match) → inserted, ``updated_at`` = ``now``;
* target only → kept (no deletes).

Several source rows matching one target row is an error, as in a MERGE;
several source rows of a key the target lacks are all inserted. Keys that
repeat in the source are found by one aggregate (partial per task, so a key
holding a third of the source costs one row per task), which is run when the
merge is defined: the few there are go into the plan as a small table. So rows
are shuffled once, for the merge, and not also to be marked; only where more
than ``FEW_REPEATED`` keys repeat are both sides joined with the aggregate.
Rows of repeated keys, and rows
with a NULL key, are salted: they match nothing and spread over all tasks of
the full outer join, which could not split a hot key. A target row whose key
repeats in the source raises through ``raise_error`` when the result is
computed. The source is read when the merge is defined and when its result is
computed: it must hold the same keys both times (stage it if it may not).

Source columns the target lacks are added (additive schema evolution): they
count as NULL in the target, are compared, and reach matched rows as well. An
update column must be in the source. Other target columns the source lacks
keep their values (NULL on insert).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

MERGE_ACTION = "merge_action"
_T, _S = "__t_", "__s_"
#: Repeated source keys that are put into the plan; more are joined by shuffle.
FEW_REPEATED = 1_000


def _salt(df: DataFrame, alone, sign: int):
    """0 for rows that may match; for a row that stands ``alone`` a hash of its
    input partition and content, so it is the same when a lost task is recomputed
    and identical copies from different input partitions go to different tasks."""
    h = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in df.columns])
    return F.when(alone, F.lit(sign) * (F.abs(h % (2 ** 62)) + 1)).otherwise(F.lit(0).cast("long"))


def upsert(target: DataFrame, source: DataFrame, keys, update_cols, now=None,
           only_changed: bool = True, updated_at: str = "updated_at",
           with_action: bool = False) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    tcols, scols = list(target.columns), list(source.columns)
    update_cols = [c for c in update_cols if c not in keys]
    absent = [c for c in update_cols if c not in scols and c != updated_at]
    if absent:
        raise ValueError(f"update columns missing from the source: {absent}")
    added = [c for c in scols if c not in tcols]
    update_cols += [c for c in added if c not in update_cols]
    out_cols = tcols + added
    missing = [k for k in keys if k not in tcols or k not in scols]
    if missing:
        raise ValueError(f"merge keys missing on one side: {missing}")
    ts = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")

    # Keys that repeat in the source (NULL keys never match, so they never repeat).
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    repeated = (source.select(*keys).filter(~no_key).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
                .filter(F.col("__n") > 1).select(*keys, F.lit(True).alias("__again")))

    some = repeated.limit(FEW_REPEATED + 1).collect()  # a bounded number of keys
    if 0 < len(some) <= FEW_REPEATED:
        repeated = F.broadcast(source.sparkSession.createDataFrame(some, repeated.schema))

    def marked(df: DataFrame) -> DataFrame:
        if not some:
            return df.withColumn("__again", F.lit(False))
        return df.join(repeated, keys, "left").select(*df.columns, F.coalesce(F.col("__again"), F.lit(False)).alias("__again"))

    s = marked(source)
    s = s.select(*[F.col(c).alias(_S + c) for c in scols],
                 _salt(source, no_key | F.col("__again"), 1).alias("__s_salt"), F.lit(True).alias("__s"))
    # Target rows whose key repeats in the source are the error case; flag
    # them so the guard below depends on the row (a filter pushed into the
    # plan can then never fire it for other rows).
    t = marked(target)
    t = t.select(*[F.col(c).alias(_T + c) for c in tcols], _salt(target, no_key, -1).alias("__t_salt"),
                 F.lit(True).alias("__t"), F.col("__again").alias("__t_clash"))
    cond = [t[_T + k] == s[_S + k] for k in keys] + [t["__t_salt"] == s["__s_salt"]]
    j = t.join(s, cond, "full")

    in_t = F.col("__t").isNotNull()
    in_s = F.col("__s").isNotNull()
    matched = in_t & in_s

    def old(c):
        return F.col(_T + c) if c in tcols else F.lit(None).cast(source.schema[c].dataType)

    # The audit stamp itself never counts as a change.
    changed = F.lit(False)
    for c in update_cols:
        if c != updated_at:
            changed = changed | ~old(c).eqNullSafe(F.col(_S + c))
    apply_update = matched & (changed if only_changed else F.lit(True))

    exprs = {}
    for c in out_cols:
        sv = F.col(_S + c) if c in scols else F.lit(None)
        if c == updated_at:
            v = F.when(apply_update | ~in_t, ts).otherwise(old(c))
        elif c in update_cols:
            v = F.when(apply_update | ~in_t, sv).otherwise(old(c))
        else:
            v = F.when(in_t, old(c)).otherwise(sv)
        exprs[c] = v
    message = F.lit(f"upsert: several source rows match one target row on {keys}")
    exprs[keys[0]] = F.when(F.col("__t_clash"), F.raise_error(message)).otherwise(exprs[keys[0]])
    out = [e.alias(c) for c, e in exprs.items()]
    if with_action:
        out.append(F.when(~in_t, F.lit("insert")).when(~in_s, F.lit("keep"))
                   .when(apply_update, F.lit("update")).otherwise(F.lit("noop")).alias(MERGE_ACTION))
    return j.select(*out)
