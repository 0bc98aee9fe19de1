"""SCD Type 1 upsert semantics."""
import pytest
from pyspark.errors import PySparkException
from pyspark.sql.utils import AnalysisException  # noqa: F401

from starweave.operators.upsert import MERGE_ACTION, upsert

T = [("K1", "a", "2020-01-01 00:00:00", "2020-01-01 00:00:00"),
     ("K2", "b", "2020-01-01 00:00:00", "2020-01-01 00:00:00"),
     ("K3", "c", "2020-01-01 00:00:00", "2020-01-01 00:00:00")]
SCHEMA = "k string, v string, created_at string, updated_at string"
NOW = "2024-06-01 00:00:00"


def frames(spark, source_rows):
    t = spark.createDataFrame(T, SCHEMA).selectExpr("k", "v", "cast(created_at as timestamp) created_at",
                                                   "cast(updated_at as timestamp) updated_at")
    s = spark.createDataFrame(source_rows, SCHEMA).selectExpr(
        "k", "v", "cast(created_at as timestamp) created_at", "cast(updated_at as timestamp) updated_at")
    return t, s


def test_update_noop_insert_keep_nullkey(spark):
    t, s = frames(spark, [("K1", "A", NOW, NOW),        # matched, changed
                          ("K2", "b", NOW, NOW),        # matched, unchanged
                          ("K4", "d", NOW, NOW),        # new
                          (None, "n", NOW, NOW)])       # NULL key never matches
    out = {(r.k, r[MERGE_ACTION]): r for r in upsert(t, s, "k", ["v"], NOW, with_action=True).collect()}
    assert set(out) == {("K1", "update"), ("K2", "noop"), ("K3", "keep"), ("K4", "insert"), (None, "insert")}
    assert out[("K1", "update")].v == "A"
    assert str(out[("K1", "update")].updated_at) == NOW
    assert str(out[("K1", "update")].created_at) == "2020-01-01 00:00:00"  # not in the update list
    assert str(out[("K2", "noop")].updated_at) == "2020-01-01 00:00:00"


def test_always_update_mode(spark):
    t, s = frames(spark, [("K2", "b", NOW, NOW)])
    out = {r.k: r[MERGE_ACTION] for r in upsert(t, s, "k", ["v"], NOW, only_changed=False,
                                                  with_action=True).collect()}
    assert out["K2"] == "update"


def test_idempotent(spark):
    t, s = frames(spark, [("K1", "A", NOW, NOW), ("K4", "d", NOW, NOW)])
    once = upsert(t, s, "k", ["v"], NOW)
    twice = upsert(once, s, "k", ["v"], NOW)
    assert sorted(once.collect(), key=str) == sorted(twice.collect(), key=str)


def test_duplicate_source_key_raises(spark):
    t, s = frames(spark, [("K1", "x", NOW, NOW), ("K1", "y", NOW, NOW)])
    with pytest.raises(PySparkException, match="several source rows"):
        upsert(t, s, "k", ["v"], NOW).collect()


def test_duplicate_new_keys_are_inserted(spark):
    t, s = frames(spark, [("K9", "x", NOW, NOW), ("K9", "y", NOW, NOW)])
    assert upsert(t, s, "k", ["v"], NOW).filter("k = 'K9'").count() == 2


def test_composite_key(spark):
    t = spark.createDataFrame([("O1", "L1", 1), ("O1", "L2", 2)], "o string, l string, q int")
    s = spark.createDataFrame([("O1", "L2", 5), ("O2", "L1", 7)], "o string, l string, q int")
    out = {(r.o, r.l): r.q for r in upsert(t, s, ["o", "l"], ["q"], NOW).collect()}
    assert out == {("O1", "L1"): 1, ("O1", "L2"): 5, ("O2", "L1"): 7}


def test_new_source_column_is_added(spark):
    t = spark.createDataFrame([("K1", "a")], "k string, v string")
    s = spark.createDataFrame([("K2", "b", 1)], "k string, v string, extra int")
    out = upsert(t, s, "k", ["v", "extra"], NOW)
    assert out.columns == ["k", "v", "extra"]
    assert {r.k: r.extra for r in out.collect()} == {"K1": None, "K2": 1}


def test_null_keys_on_both_sides_never_match(spark):
    t = spark.createDataFrame([(None, "t1"), (None, "t2"), ("K1", "a")], "k string, v string")
    s = spark.createDataFrame([(None, "s1"), (None, "s2"), ("K1", "b")], "k string, v string")
    out = upsert(t, s, "k", ["v"], NOW, with_action=True).collect()
    got = sorted((r.k, r.v, r[MERGE_ACTION]) for r in out if r.k is None)
    assert got == [(None, "s1", "insert"), (None, "s2", "insert"), (None, "t1", "keep"), (None, "t2", "keep")]
    assert [r.v for r in out if r.k == "K1"] == ["b"]


def test_hot_new_key_bypasses_the_full_outer_join(spark):
    t = spark.range(100).selectExpr("cast(id as string) k", "id v")
    hot = spark.range(5000).selectExpr("'HOT' k", "id v")  # one new key, many rows
    s = spark.range(50, 150).selectExpr("cast(id as string) k", "id * 2 v").unionByName(hot)
    out = upsert(t, s, "k", ["v"], NOW, with_action=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "BroadcastHashJoin" in plan
    got = {r[MERGE_ACTION]: r.n for r in out.groupBy(MERGE_ACTION).count().withColumnRenamed("count", "n").collect()}
    assert got == {"keep": 50, "update": 50, "insert": 5050}
