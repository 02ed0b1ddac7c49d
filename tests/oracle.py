"""Comparison of a query with its SQL in DuckDB."""

import glob
import os

import duckdb

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "float": "FLOAT"}


def connect(data: str = DATA):
    con = duckdb.connect()
    for p in glob.glob(f"{data}/*.parquet"):
        name = os.path.basename(p)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return con


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(float(v[i])) if isinstance(v[i], float) else repr(v[i]) for i in order) for v in values)


def same(spark, con, query, sql, data: str = DATA):
    got = query(spark, data)
    want = con.sql(sql)
    assert sorted(got.columns) == sorted(want.columns)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    types = dict(zip(want.columns, map(str, want.types)))
    assert {c: TYPES.get(t, t) for c, t in got.dtypes} == types
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())
