"""Every registered query against its DuckDB oracle on sf0.001 (the driver
runs the same comparison at sf0.01)."""

import contextlib
import io
import math

import duckdb
import pytest

import __spark_entry__ as E
from flowtables import queries as Q
from conftest import SF_SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    want_cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(want_cols)
    assert len(got) == len(want)
    assert _rows(df.columns, got) == _rows(want_cols, want)
    plan = explain(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def explain(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_every_query_has_a_callable():
    qs = E.queries()
    assert set(E.oracle_sql()) <= set(qs)
    assert set(Q.ORACLES) == set(Q.QUERIES)  # every query of the library itself has SQL
    assert len(qs) >= 60


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "group_name" in df.columns
