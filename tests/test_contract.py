"""The driver contract on the smallest tables: entry runs, every SQL-checked query equals
its DuckDB oracle, every query returns a stable schema."""

import math
from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.conftest import SF0001


def test_entry_runs(spark, have_data):
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"Coping_Struggles", "column_name", "mean"}


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (v if math.isinf(v) else round(v, 6) + 0.0)
    return v


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, have_data, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in Path(SF0001).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    sdf = entry.queries()[name](spark, SF0001)
    s_cols, s_rows = sdf.columns, sdf.collect()
    res = con.execute(entry.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    si = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    di = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    a = Counter(tuple(repr(_norm(r[i])) for i in si) for r in s_rows)
    b = Counter(tuple(repr(_norm(r[i])) for i in di) for r in d_rows)
    assert a == b
