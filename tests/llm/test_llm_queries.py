"""Every registered query of the subpackage: one row per row of its table, and its SQL on the smallest tables."""

import duckdb
import pytest

from flowtables.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    res = duck.execute(ORACLES[name])
    cols = sorted(d[0] for d in res.description)
    assert cols == sorted(df.columns)
    order = [[d[0] for d in res.description].index(c) for c in cols]
    want = sorted((tuple(r[i] for i in order) for r in res.fetchall()), key=str)
    assert sorted((tuple(r) for r in df.select(*cols).collect()), key=str) == want


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
