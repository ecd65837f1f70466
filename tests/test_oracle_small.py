"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver runs the same comparison at sf0.01)."""
from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SMALL_DIR

TABLES = E.TABLES
# The stored-size oracles read the sf0.01 folder by path; they are covered by the
# driver's run and by test_io.
PATH_BOUND = {"stored_datasets", "dataset_size_lineitem"}
NAMES = sorted(n for n in E.queries() if n in E.oracle_sql() and n not in PATH_BOUND)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SMALL_DIR, t + '.parquet')}')")
    return c


def _norm(v):
    if v is None:
        return "\0"
    if isinstance(v, float):
        return repr(v) if not math.isnan(v) else "nan"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SMALL_DIR)
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    exp_cols, exp = [d[0] for d in res.description], res.fetchall()
    assert sorted(got_cols) == sorted(exp_cols)
    assert len(got) == len(exp)
    assert _bag(got_cols, got) == _bag(exp_cols, exp)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["customer_id", "total_revenue", "units_purchased"]
    assert 0 < df.count() <= 10
