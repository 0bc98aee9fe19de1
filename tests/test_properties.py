"""Property checks against brute-force Python models on random small inputs."""
from hypothesis import HealthCheck, given, settings, strategies as st

from starweave.operators.dedup import keep_latest
from starweave.operators.upsert import MERGE_ACTION, upsert

KEYS = st.sampled_from(["a", "b", "c", None])
ROWS = st.lists(st.tuples(KEYS, st.integers(0, 3), st.integers(0, 2)), min_size=0, max_size=12)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(rows=ROWS)
def test_keep_latest_matches_model(spark, rows):
    df = spark.createDataFrame(rows, "k string, ts int, v int")
    got = sorted(tuple(r) for r in keep_latest(df.filter("k is not null"), "k", "ts", ["v"]).collect())
    best = {}
    for k, ts, v in rows:
        if k is not None and (k not in best or (ts, -v) > (best[k][0], -best[k][1])):
            best[k] = (ts, v)  # latest ts; ties → smallest v (ascending tie-break)
    assert got == sorted((k, ts, v) for k, (ts, v) in best.items())


@SETTINGS
@given(target=st.lists(st.tuples(KEYS, st.integers(0, 2)), max_size=6,
                       unique_by=lambda r: r[0] if r[0] is not None else object()),
       source=st.lists(st.tuples(KEYS, st.integers(0, 2)), max_size=6))
def test_upsert_matches_model(spark, target, source):
    t = spark.createDataFrame(target, "k string, v int")
    s = spark.createDataFrame(source, "k string, v int")
    counts = {}
    for k, _ in source:
        if k is not None:
            counts[k] = counts.get(k, 0) + 1
    tkeys = {k for k, _ in target if k is not None}
    if any(counts.get(k, 0) > 1 for k in tkeys):
        return  # the error case is covered in test_upsert.py
    got = sorted((r.k or "", r.v, r[MERGE_ACTION])
                 for r in upsert(t, s, "k", ["v"], "2024-01-01 00:00:00", with_action=True).collect())
    model = []
    src = {k: v for k, v in source if k is not None and counts[k] == 1}
    for k, v in target:
        if k is not None and k in src:
            model.append((k, src[k], "update" if src[k] != v else "noop"))
        else:
            model.append((k or "", v, "keep"))
    for k, v in source:
        if k is None or k not in tkeys:
            model.append((k or "", v, "insert"))
    assert got == sorted(model)


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.one_of(st.none(), st.integers(-2, 4))),
                     max_size=15))
def test_quality_suite_matches_model(spark, rows):
    from starweave.operators.quality import DuplicateRate, NullRate, RowCount, ValueRange, run_checks
    df = spark.createDataFrame(rows, "k string, q int")
    got = {r.check_name: (r.observed, r.passed) for r in run_checks(
        df, "t", [RowCount(), NullRate(("k", "q"), 0.25), DuplicateRate(("k",), 0.0), ValueRange("q", 0, 3)]
    ).collect()}
    n = len(rows)
    nulls_k = sum(k is None for k, _ in rows)
    nulls_q = sum(q is None for _, q in rows)
    distinct = len({k for k, _ in rows})  # NULL counts as one value
    out = sum(q is not None and not (0 <= q <= 3) for _, q in rows)
    assert got["row_count_check"] == (n, n >= 1)
    assert got["null_check_k"] == (nulls_k, n > 0 and nulls_k / n <= 0.25)
    assert got["null_check_q"] == (nulls_q, n > 0 and nulls_q / n <= 0.25)
    assert got["duplicate_check"] == (n - distinct, n == 0 or (n - distinct) / n <= 0.0)
    assert got["range_check_q"] == (out, out == 0)
