"""Every query with SQL gives the rows that DuckDB gives for it."""

import duckdb
import pytest

from skein import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def cell(v):
    return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else None if v is None else str(v)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = [tuple(cell(v) for v in r) for r in df.select(*columns).collect()]
    want = duck.sql(f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert sorted(got, key=str) == sorted((tuple(cell(v) for v in r) for r in want), key=str)
