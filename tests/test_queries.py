"""Every query that states its SQL gives the same rows in DuckDB; the others give rows."""

import duckdb
import pytest

from starloom.queries import ORACLE, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    return con


def ordered(df):
    df = df[sorted(df.columns)].astype(object)
    return sorted(map(tuple, df.where(df.notna(), None).values.tolist()), key=str)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, duck, data, name):
    got, want = QUERIES[name](spark, data).toPandas(), duck.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    for a, b in zip(ordered(got), ordered(want), strict=True):
        assert all(x == y or (isinstance(x, float) and abs(x - y) <= 2e-6 * max(1, abs(x))) for x, y in zip(a, b)), (a, b)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_gives_rows(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0
