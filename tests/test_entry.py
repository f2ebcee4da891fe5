"""Driver contract: entry(), every query vs its DuckDB oracle (sf0.001), and
plan properties (no Python evaluation, pruned scans, pushed filters)."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from aurum.plans.catalog import QUERIES
from aurum.plans.oracle_queries import ORACLE
from helpers import SF_SMOKE

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_revenue_usd" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.keys() <= E.queries().keys() and ORACLE.keys() <= E.oracle_sql().keys() <= E.queries().keys()


def test_declared_not_null_tests_find_rows(spark):
    found = QUERIES["test_not_null"](spark, SF_SMOKE).groupBy("model", "column_name").count().collect()
    assert {("stg_sales_transactions", "amount"), ("stg_iot_readings", "device_id")} <= {(r[0], r[1]) for r in found}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMOKE)
    cols, got = df.columns, df.collect()
    rel = duck.sql(ORACLE[name])
    ocols, exp = rel.columns, rel.fetchall()
    assert sorted(cols) == sorted(ocols)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
    a = sorted((tuple(canon(r[i]) for i in order) for r in got), key=str)
    b = sorted((tuple(canon(r[i]) for i in oorder) for r in exp), key=str)
    assert a == b


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["daily_sales_summary", "customer_360", "web_sessions", "iot_anomaly",
                                  "upsert_merge", "snapshot_diff", "pii_policy", "dq_report"])
def test_no_python_evaluation(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMOKE))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scan_pruning_and_pushdown(spark):
    plan = QUERIES["stg_sales"](spark, SF_SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert "l_discount" not in plan and "l_tax" not in plan  # columns the feed does not use are never read
    inc = QUERIES["incremental_filter"](spark, SF_SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThan(l_shipdate" in inc
