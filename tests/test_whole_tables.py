"""Queries over whole tables give the rows of their SQL without its cuts, on a small table."""

import pytest

from panelloom import queries
from tests.test_queries_against_sql import SF_DIR, con, plain, pytestmark  # noqa: F401

#: Of each query: the SQL's query and what is cut out of its text.
NETWORK = [("code < 40 AND ", "")]
WHOLE = {f"{n}_whole": (n, NETWORK) for n in ("n01_pair_correlations", "n02_neighbours", "n03_peer_stats", "n04_tightness", "n04_two_hop", "n06_donor_beta")}
SPANS = [("o_custkey % 100 AS code", "o_custkey AS code"), (" WHERE o_orderkey % 10 = 0", "")]
WHOLE |= {f"{n}_whole": (n, cuts) for n, cuts in {
    "s20_merge_intervals": SPANS, "s20_missing_intervals": SPANS, "s13_replace_days": [("event_id % 2 = 0 AND ", "")], "s10_unpack_dump": [(" WHERE event_id % 50 = 0", "")],
    "j01_asof": [(" WHERE event_id % 3 = 0", "")], "j01_asof_strict_aged": [(" WHERE event_id % 3 = 0", "")], "r07_others": [(" AND code % 7 = 0", "")], "g09_session_runs": [("l_suppkey % 10 = 1 AND ", "")],
}.items()}


@pytest.fixture(scope="module")
def many(tmp_path_factory):
    """The tables of SF_DIR, with the events of each user under a second code over 40, too, at other values."""
    import os

    import duckdb

    out = str(tmp_path_factory.mktemp("whole"))
    for f in os.listdir(SF_DIR):
        os.symlink(f"{SF_DIR}/{f}", f"{out}/{f}") if f != "events.parquet" else None
    duckdb.sql(f"COPY (SELECT * FROM '{SF_DIR}/events.parquet' UNION ALL BY NAME SELECT * REPLACE (user_id + 1000 AS user_id, value * (1 + event_id % 7) AS value) FROM '{SF_DIR}/events.parquet') TO '{out}/events.parquet' (FORMAT parquet)")
    return out


@pytest.mark.parametrize("name", sorted(WHOLE))
def test_whole_query(spark, con, many, name):  # noqa: F811
    base, cuts = WHOLE[name]
    sql = queries.SQL[base]
    for old, new in cuts:
        assert old in sql
        sql = sql.replace(old, new)
    con.sql(f"CREATE OR REPLACE VIEW events AS SELECT * FROM '{many}/events.parquet'")
    df = queries.QUERIES[name](spark, many)
    columns = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    quoted = ", ".join(f'"{c}"' for c in columns)
    assert got == sorted(tuple(map(plain, r)) for r in con.sql(f"SELECT {quoted} FROM ({sql})").fetchall())
    assert got


def test_centrality_of_all_codes(spark, many):
    got = {r.code for r in queries.QUERIES["n05_eigen_centrality"](spark, many).collect()}
    assert got == {c for r in queries.QUERIES["n02_neighbours_whole"](spark, many).collect() for c in (r.i, r.j)} and max(got) > 1000
