"""Every query that has SQL gives the rows that DuckDB gives on the same files."""

import math
import os

import duckdb
import pytest

from panelloom import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "~"
    if isinstance(v, bool) or not isinstance(v, int | float):
        return str(v)
    return repr(float(v))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, con, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    rel = con.sql(queries.SQL[name])
    assert sorted(rel.columns) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = sorted(tuple(map(plain, r)) for r in con.sql(f"SELECT {quoted} FROM ({queries.SQL[name]})").fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_runs(spark, name):
    assert queries.QUERIES[name](spark, SF_DIR).limit(5).count() >= 0
