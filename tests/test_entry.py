"""Driver contract: entry runs, every query has an oracle, a few match DuckDB at sf0.001."""
import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["category", "order_lines", "total_units", "total_revenue", "total_profit",
                          "avg_margin_pct"]
    assert len(rows) >= 1


def test_every_query_has_oracle():
    own = {k for k, f in E.queries().items() if f.__module__ == E.__name__}
    assert own and own <= set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 38


@pytest.mark.parametrize("key", ["silver_orders", "fact_sales", "rpt_category", "rpt_segment",
                                 "dq_suite", "scd1_upsert", "dim_date"])
def test_query_matches_oracle(spark, key):
    import duckdb
    from tools.compare_oracle import TABLES, canon
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[key](spark, SF)
    rel = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(dcols)
    assert canon(df.columns, df.collect()) == canon(dcols, rel.fetchall())
