"""Single-pass data-quality checks."""
from starweave.operators.quality import (DuplicateRate, NullRate, RegexMatch, RowCount, ValueRange,
                                         CheckFailed, enforce, foreign_keys, overall, referential_integrity, row_counts, run_checks)

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starweave.plans import suites


def checks(df, *cs):
    return {r.check_name: r for r in run_checks(df, "t", cs).collect()}


def test_row_count_pass_fail(spark):
    assert checks(spark.createDataFrame([("a",), ("b",)], "col string"), RowCount(1))["row_count_check"].passed
    assert not checks(spark.createDataFrame([], "col string"), RowCount(1))["row_count_check"].passed


def test_null_check_pass_fail(spark):
    ok = spark.createDataFrame([("1", "x"), ("2", "y")], "id string, val string")
    bad = spark.createDataFrame([("1", None), ("2", None)], "id string, val string")
    assert checks(ok, NullRate(("val",)))["null_check_val"].passed
    r = checks(bad, NullRate(("val",)))["null_check_val"]
    assert not r.passed and r.observed == 2 and r.total == 2


def test_duplicate_pass_fail(spark):
    assert checks(spark.createDataFrame([("A",), ("B",), ("C",)], "id string"),
                  DuplicateRate(("id",)))["duplicate_check"].passed
    r = checks(spark.createDataFrame([("A",), ("A",), ("B",)], "id string"),
               DuplicateRate(("id",), 0.0))["duplicate_check"]
    assert not r.passed and r.observed == 1


def test_empty_frame(spark):
    got = checks(spark.createDataFrame([], "id string"), NullRate(("id",)), DuplicateRate(("id",)))
    assert not got["null_check_id"].passed and got["duplicate_check"].passed


def test_nulls_count_as_one_key(spark):
    r = checks(spark.createDataFrame([(None,), (None,), ("A",)], "id string"),
               DuplicateRate(("id",), 0.0))["duplicate_check"]
    assert r.observed == 1


def test_range_and_regex_null_pass(spark):
    df = spark.createDataFrame([(5, "a@b.com"), (None, None), (0, "bad")], "q int, e string")
    got = checks(df, ValueRange("q", 1), RegexMatch("e", r"^[^@]+@[^@]+$"))
    assert got["range_check_q"].observed == 1
    assert got["regex_check_e"].observed == 1
    assert checks(df, ValueRange("q"))["range_check_q"].passed  # no bounds: always passes


def test_one_pass(spark):
    df = spark.createDataFrame([(1, "a")], "q int, e string")
    plan = run_checks(df, "t", [RowCount(), NullRate(("q", "e")), DuplicateRate(("q",)),
                                ValueRange("q", 0, 9)])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") + plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") == 1


def test_referential_integrity_null_is_one_orphan(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,), (None,), (9,)], "fk int")
    dim = spark.createDataFrame([(1,), (2,)], "pk int")
    r = referential_integrity(fact, dim, "fk", "pk", "f").first()
    assert r.observed == 2 and not r.passed


def test_row_counts(spark):
    out = row_counts({("L", "a"): spark.range(3), ("L", "b"): spark.range(0)})
    assert {r.table_name: r.row_count for r in out.collect()} == {"a": 3, "b": 0}


def test_enforce_fails_job(spark):
    bad = run_checks(spark.createDataFrame([], "id string"), "t", [RowCount()])
    with pytest.raises(CheckFailed, match="data-quality check failed"):
        enforce(bad)


def test_overall_flag_per_table(spark):
    r = spark.createDataFrame([("a", True), ("a", False), ("b", True)], "table_name string, passed boolean")
    assert {x.table_name: (x.checks, x.failed, x.passed) for x in overall(r).collect()} == {"a": (2, 1, False), "b": (1, 0, True)}


def test_referential_integrity_total_counts_distinct_keys(spark):
    fact, dim = spark.createDataFrame([(1,), (1,), (2,), (9,)], "fk int"), spark.createDataFrame([(1,), (2,)], "pk int")
    r = referential_integrity(fact, dim, "fk", "pk", "f").first()
    assert (r.observed, r.total, r.passed) == (1, 3, False)


def test_foreign_keys_in_one_pass(spark):
    fact = spark.createDataFrame([(1, 10), (1, 20), (2, None), (5, None), (5, 30)], "a long, b int")
    one, two = spark.createDataFrame([(1,), (2,), (2,)], "k long"), spark.createDataFrame([(10,), (None,)], "j int")
    pairs = [("a", one, "k"), ("b", two, "j")]
    got = foreign_keys(fact, pairs, "f")
    singly = referential_integrity(fact, one, "a", "k", "f").unionByName(referential_integrity(fact, two, "b", "j", "f"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, singly.collect()), key=str)
    assert {r.check_name: (r.observed, r.total) for r in got.collect()} == {"ref_integrity_a": (1, 3), "ref_integrity_b": (3, 4)}
    empty = foreign_keys(fact.limit(0), pairs, "f").collect()
    assert [(r.observed, r.total, r.passed) for r in empty] == [(0, 0, True)] * 2


def test_one_colliding_surrogate_key_fails_the_suite(spark):
    dim = spark.range(1000).select(F.col("id").alias("bk"), F.when(F.col("id") == 7, 8).otherwise(F.col("id")).alias("sk"))
    results = {r.table_name: r.passed for r in suites.dimension_checks(dim, "d", "bk", "sk").filter("check_name = 'duplicate_check'").collect()}
    assert results == {"d": True, "d:sk": False}
