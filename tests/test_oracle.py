"""Every registered query against its SQL twin on the smallest data set."""

import os
import re

import duckdb
import pytest

from scripts.oracle_check import TABLES, rows_of

SF = "/root/testdata/sf0.001"


def library(entries):
    """The library's own entries; the training-data operators have tests of their own."""
    return {k: v for k, v in entries.items() if not re.match(r"op\d+_|pipeline$", k)}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_matches_its_sql(spark, con):
    from __spark_entry__ import oracle_sql, queries
    qs, sql = library(queries()), library(oracle_sql())
    assert set(sql) <= set(qs)
    failures = []
    for k, fn in qs.items():
        df = fn(spark, SF)
        got = df.collect()
        if k not in sql:
            continue
        rel = con.sql(sql[k])
        if sorted(df.columns) != sorted(rel.columns):
            failures.append((k, "columns"))
        elif rows_of(df.columns, got) != rows_of(rel.columns, rel.fetchall()):
            failures.append((k, "values"))
    assert not failures


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["region", "withdrawal_rate"] and df.count() >= 0


def test_no_query_plans_a_cartesian_join(spark):
    from __spark_entry__ import queries
    flagged = []
    for k, fn in library(queries()).items():
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        flagged += [(k, m) for m in ("CartesianProduct", "BroadcastNestedLoopJoin") if m in plan]
    assert not flagged
