"""Split rows into valid and rejected, with the names of the failed rules.

A rule is a boolean Column; NULL counts as failed (a NULL operand in
``price > 0`` must not let the row through). Both outputs come from one
tagged frame: stage it (``tables.stage``) so the upstream lineage is evaluated once.
"""
from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

REASONS = "reject_reasons"


class Split(NamedTuple):
    valid: DataFrame
    rejected: DataFrame


def reasons_expr(rules: dict):
    failed = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    if not failed:
        return F.array().cast("array<string>")
    return F.filter(F.array(*failed), lambda r: r.isNotNull())


def tag_rules(df: DataFrame, rules: dict, existing: str | None = None) -> DataFrame:
    """Add (or extend) the ``reject_reasons`` array column."""
    tagged = reasons_expr(rules)
    if existing and existing in df.columns:
        tagged = F.concat(F.col(existing), tagged)
    return df.withColumn(REASONS, tagged)


def split_valid(df: DataFrame, rules: dict) -> Split:
    tagged = tag_rules(df, rules, existing=REASONS)
    ok = F.size(F.col(REASONS)) == 0
    return Split(tagged.filter(ok).drop(REASONS), tagged.filter(~ok))
