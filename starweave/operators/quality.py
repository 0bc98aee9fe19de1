"""Data-quality checks as one aggregate pass per table.

Every check of a suite is an aggregate expression over the same scan, so
a table is read once however many checks it has (a naive suite runs one
``count()`` job per check). The single result row is turned into one row
per check inside the plan, so nothing is collected to the driver:

    table_name string, check_name string, observed bigint, total bigint,
    threshold double, passed boolean

* row count     : observed = rows; passes when rows >= min_count
* null rate     : observed = NULLs; passes when total > 0 and NULLs / total <= threshold
* duplicate rate: observed = total - distinct keys (NULLs equal each other);
                  passes when total = 0 or observed / total <= threshold
* value range   : observed = rows outside [min, max] (inclusive, NULL passes)
* regex         : observed = rows whose value has no match (find-anywhere, NULL passes)

At most one duplicate-rate check runs per pass: a distinct aggregate is
planned as a shuffle on the key, and several distinct keys in one
aggregate would be planned with ``Expand`` (one copy of the data per key).
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# Default thresholds (5 % NULLs, 1 % duplicates, at least one row).
NULL_THRESHOLD = 0.05
DUPLICATE_THRESHOLD = 0.01
MIN_ROW_COUNT = 1


@dataclass(frozen=True)
class Check:
    pass


@dataclass(frozen=True)
class RowCount(Check):
    min_count: int = MIN_ROW_COUNT


@dataclass(frozen=True)
class NullRate(Check):
    columns: tuple
    threshold: float = NULL_THRESHOLD


@dataclass(frozen=True)
class DuplicateRate(Check):
    keys: tuple
    threshold: float = DUPLICATE_THRESHOLD


@dataclass(frozen=True)
class ValueRange(Check):
    column: str
    min_value: object = None
    max_value: object = None


@dataclass(frozen=True)
class RegexMatch(Check):
    column: str
    pattern: str


def _row(table: str, name: str, observed: Column, total: Column, threshold, passed: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"), F.lit(name).alias("check_name"),
        observed.cast("bigint").alias("observed"), total.cast("bigint").alias("total"),
        F.lit(threshold).cast("double").alias("threshold"), passed.alias("passed"))


def run_checks(df: DataFrame, table: str, checks) -> DataFrame:
    """Evaluate ``checks`` in one pass over ``df``; one result row per check."""
    checks = list(checks)
    if sum(isinstance(c, DuplicateRate) for c in checks) > 1:
        raise ValueError("one DuplicateRate per pass; run another suite for a second key")
    aggs, plan = [F.count(F.lit(1)).alias("__total")], []
    for i, chk in enumerate(checks):
        if isinstance(chk, RowCount):
            plan.append((chk, None))
        elif isinstance(chk, NullRate):
            names = []
            for j, c in enumerate(chk.columns):
                aggs.append(F.count_if(F.col(c).isNull()).alias(f"__n{i}_{j}"))
                names.append((c, f"__n{i}_{j}"))
            plan.append((chk, names))
        elif isinstance(chk, DuplicateRate):
            aggs.append(F.count_distinct(F.struct(*[F.col(k) for k in chk.keys])).alias(f"__d{i}"))
            plan.append((chk, f"__d{i}"))
        elif isinstance(chk, ValueRange):
            cond = F.lit(True)
            if chk.min_value is not None:
                cond = cond & (F.col(chk.column) >= F.lit(chk.min_value))
            if chk.max_value is not None:
                cond = cond & (F.col(chk.column) <= F.lit(chk.max_value))
            aggs.append(F.count_if(~cond).alias(f"__r{i}"))
            plan.append((chk, f"__r{i}"))
        elif isinstance(chk, RegexMatch):
            aggs.append(F.count_if(~F.col(chk.column).rlike(chk.pattern)).alias(f"__x{i}"))
            plan.append((chk, f"__x{i}"))
        else:
            raise TypeError(f"unknown check {chk!r}")

    total = F.col("__total")
    rows = []
    for chk, ref in plan:
        if isinstance(chk, RowCount):
            rows.append(_row(table, "row_count_check", total, total, float(chk.min_count),
                             total >= chk.min_count))
        elif isinstance(chk, NullRate):
            for c, a in ref:
                rate_ok = (total > 0) & ((F.col(a) / total) <= chk.threshold)
                rows.append(_row(table, f"null_check_{c}", F.col(a), total, chk.threshold,
                                 F.coalesce(rate_ok, F.lit(False))))
        elif isinstance(chk, DuplicateRate):
            dups = total - F.col(ref)
            ok = (total == 0) | ((dups / total) <= chk.threshold)
            rows.append(_row(table, "duplicate_check", dups, total, chk.threshold, ok))
        elif isinstance(chk, ValueRange):
            rows.append(_row(table, f"range_check_{chk.column}", F.col(ref), total, None,
                             F.col(ref) == 0))
        elif isinstance(chk, RegexMatch):
            rows.append(_row(table, f"regex_check_{chk.column}", F.col(ref), total, None,
                             F.col(ref) == 0))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def referential_integrity(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, table: str) -> DataFrame:
    """Distinct foreign keys of ``fact`` absent from ``dim`` (a NULL key is one orphan).

    ``observed`` counts the orphans, ``total`` the distinct foreign keys. The
    distinct is a partial + final aggregate, so the join sees one row per key;
    its output is already hash-partitioned on the key, so only the dimension
    keys are shuffled to meet it.
    """
    fks = fact.select(F.col(fact_key).alias("__fk")).distinct()
    pks = dim.select(F.col(dim_key).alias("__pk")).distinct()
    met = fks.join(pks, fks["__fk"] == pks["__pk"], "left")
    return met.agg(F.count_if(F.col("__pk").isNull()).alias("__o"), F.count(F.lit(1)).alias("__t")).select(F.inline(F.array(
        _row(table, f"ref_integrity_{fact_key}", F.col("__o"), F.col("__t"), None, F.col("__o") == 0))))


def foreign_keys(fact: DataFrame, pairs: list, table: str) -> DataFrame:
    """``referential_integrity`` of several keys in one pass: ``pairs`` lists (fact key, dimension, dimension key).

    Every fact row is unpivoted to (key number, value) and made distinct map-side, so
    one scan and one shuffle serve all keys; the dimensions' keys are one union
    under the same numbers. A key holding a third of the rows costs one row a task.
    Keys are compared as LONG. There is a check row for each pair, also of an empty fact.
    """
    name, value = F.col("__k.n"), F.col("__k.v")
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("n"), F.col(fk).cast("long").alias("v")) for i, (fk, _, _) in enumerate(pairs)]))
    used = fact.select(each.alias("__k")).select(name.alias("__n"), value.alias("__fk")).distinct()
    known = None
    for i, (_, dim, pk) in enumerate(pairs):
        own = dim.select(F.lit(i).alias("__m"), F.col(pk).cast("long").alias("__pk"))
        known = own if known is None else known.unionByName(own)
    met = used.join(known.distinct(), (F.col("__n") == F.col("__m")) & (F.col("__fk") == F.col("__pk")), "left")
    counts, rows = [], []
    for i, (fk, _, _) in enumerate(pairs):
        mine = F.col("__n") == i
        counts += [F.count_if(mine & F.col("__pk").isNull()).alias(f"__o{i}"), F.count_if(mine).alias(f"__t{i}")]
        rows.append(_row(table, f"ref_integrity_{fk}", F.col(f"__o{i}"), F.col(f"__t{i}"), None, F.col(f"__o{i}") == 0))
    return met.agg(*counts).select(F.inline(F.array(*rows)))


def overall(results: DataFrame) -> DataFrame:
    """One row per table: its number of checks, how many failed, and whether all passed."""
    return results.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("checks"), F.count_if(~F.col("passed")).alias("failed"),
        F.min("passed").alias("passed"))


def row_counts(tables: dict) -> DataFrame:
    """``{(layer, name): DataFrame}`` → one row per table: layer, table_name, row_count."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count")
             for (layer, name), df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class CheckFailed(RuntimeError):
    """A gated suite had failing checks."""


def enforce(results: DataFrame, shown: int = 20) -> None:
    """Raise if any check failed. An action of its own, so no consumer can prune it away."""
    failed = results.filter(~F.col("passed")).select("table_name", "check_name").limit(shown).collect()
    if failed:
        raise CheckFailed("data-quality check failed: " + ", ".join(f"{r.table_name} {r.check_name}" for r in failed))
