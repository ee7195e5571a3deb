"""Correlations by tiles: the rows of a plain loop on odd series, and no shuffle of pairs."""

import datetime as dt

import duckdb
import numpy as np
import pytest

from panelloom import queries
from panelloom.operators import network

CODES, DAYS = 400, 12


def shuffled(spark, run):
    """Rows that the stages of ``run`` write to shuffles."""
    gateway = spark.sparkContext._gateway
    none = gateway.jvm.java.util.ArrayList()
    written = lambda: sum({(s.stageId(), s.attemptId()): s.shuffleWriteRecords() for s in map(stages.apply, range(stages.size()))}.values())
    store = spark.sparkContext._jsc.sc().statusStore()
    counts = []
    for step in (lambda: None, run):
        step()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        stages = store.stageList(none, False, False, gateway.new_array(gateway.jvm.double, 0), none)
        counts.append(written())
    return counts[1] - counts[0]


@pytest.fixture
def large(spark):
    """Plans as for large tables: no broadcasts by size, no partitions put together."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k in conf:
        spark.conf.unset(k)


@pytest.fixture(scope="module")
def events(tmp_path_factory):
    """Events of CODES users on each of DAYS days."""
    out = str(tmp_path_factory.mktemp("network"))
    duckdb.sql(
        f"COPY (SELECT u * {DAYS} + d AS event_id, TIMESTAMP '2024-01-01' + d * INTERVAL 1 DAY AS ts, CAST(u AS BIGINT) AS user_id, 'view' AS event_type, (hash(u, d) % 100000) / 100.0 AS value "
        f"FROM range({CODES}) a(u), range({DAYS}) b(d)) TO '{out}/events.parquet' (FORMAT parquet)"
    )
    return out


@pytest.mark.parametrize("name", ["n01_pair_correlations", "n02_neighbours", "n03_peer_stats", "n04_tightness", "n06_donor_beta", "n04_two_hop", "n05_eigen_centrality"])
def test_no_shuffle_of_pairs(spark, large, events, name):
    got = []
    rows = shuffled(spark, lambda: got.extend(queries.queries_more.registered()[0][name](spark, events).collect()))
    assert got and rows < CODES * (CODES - 1) // 2


@pytest.fixture(scope="module")
def twice(events, tmp_path_factory):
    """The events of CODES users, and of as many others with values of their own."""
    out = str(tmp_path_factory.mktemp("twice"))
    duckdb.sql(f"COPY (FROM '{events}/events.parquet' UNION ALL SELECT event_id + {CODES * DAYS}, ts, user_id + {CODES}, event_type, (hash(event_id) % 100000) / 100.0 FROM '{events}/events.parquet') TO '{out}/events.parquet' (FORMAT parquet)")
    return out


@pytest.mark.parametrize("name", ["n03_peer_stats", "n06_donor_beta", "n04_two_hop", "n05_eigen_centrality"])
def test_shuffle_grows_with_entities(spark, large, events, twice, name):
    """Twice the entities shuffle twice the rows, where pairs would be four times as many; the tiles are worked out once."""
    run = queries.queries_more.registered()[0][name]
    rows, got = [], []
    for d in (events, twice):
        df = run(spark, d)
        rows.append(shuffled(spark, lambda: got.append(len(df.collect()))))
        spark.catalog.clearCache()
    assert got[1] > 1.5 * got[0] > 0 and rows[1] < 2.5 * rows[0]
    if name != "n05_eigen_centrality":  # its rounds read what is kept
        assert df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("CartesianProduct") == 1


def test_pairs_shuffle_the_panel_only(spark, large, events, twice):
    """Twice the entities give four times the pairs, all of them, and shuffle twice the rows. Counts the stages that the query began, as older ones are dropped meanwhile."""
    store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway
    none = gateway.jvm.java.util.ArrayList()

    def stages():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        found = store.stageList(none, False, False, gateway.new_array(gateway.jvm.double, 0), none)
        return {(s.stageId(), s.attemptId()): s.shuffleWriteRecords() for s in map(found.apply, range(found.size()))}

    rows = []
    for d, size in ((events, CODES), (twice, 2 * CODES)):
        before = max(stages(), default=(-1, 0))
        got = queries.queries_more.registered()[0]["n01_pair_correlations"](spark, d).select("i", "j").collect()
        rows.append(sum(n for k, n in stages().items() if k > before))
        assert len(got) == len(set(got)) == size * (size - 1) // 2
    assert 0 < rows[1] < 2.5 * rows[0]


def test_tiles_once(spark, large, events):
    """A query that uses the neighbours three times works out the tiles once."""
    df = queries.queries_more.registered()[0]["n04_tightness"](spark, events)
    assert df.collect()
    assert df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("CartesianProduct") == 1


def brute(rows, least):
    """{(i, j): (corr, n)} by a loop over pairs."""
    by = {}
    for code, day, x in rows:
        if None not in (code, day, x) and np.isfinite(x):
            by.setdefault(code, {}).setdefault(day, []).append(x)
    out = {}
    for i in by:
        for j in by:
            if i < j:
                met = np.array([(x, y) for d in by[i] if d in by[j] for x in by[i][d] for y in by[j][d]])
                if len(met) >= least and all(len(set(c)) > 1 for c in met.T):
                    u, v = (met - met.mean(0)).T
                    out[i, j] = (u @ v / np.sqrt((u @ u) * (v @ v)), len(met))
    return out


def test_pairs_of_odd_series(spark):
    """Levels, constants (also on the common days only), gaps, days with two values, no days in common, missing keys and values."""
    r = np.random.default_rng(3)
    day = lambda d: dt.date(2024, 1, 1) + dt.timedelta(d)
    rows = [(f"c{c:02}", day(d), float(r.normal())) for c in range(12) for d in range(25) if r.random() < 0.8]
    rows += [("level", day(d), 1e6 + float(r.normal())) for d in range(25)]
    rows += [("flat", day(d), 0.1) for d in range(25)]
    rows += [("steps", day(d), 0.1 if d < 20 else 1e7) for d in range(25)] + [("early", day(d), float(r.normal())) for d in range(20)]
    rows += [("twice", day(d), float(r.normal())) for d in range(25) for _ in range(2)]
    rows += [("apart", day(d), float(r.normal())) for d in range(100, 120)] + [("Ä", day(d), float(d)) for d in range(25)]
    rows += [("c00", day(40), None), ("c01", None, 1.0), (None, day(3), 2.0), ("c02", day(41), float("nan")), ("c03", day(41), float("inf"))]
    panel = spark.createDataFrame(rows, "code string, day date, x double")
    want = brute(rows, 5)
    got = {(g.i, g.j): (g.corr, g.n) for g in network.pair_correlations(panel, "x", 5).collect()}
    assert ("early", "steps") not in want and ("early", "level") in want
    assert {p: n for p, (_, n) in got.items()} == {p: n for p, (_, n) in want.items()}
    assert all(got[p][0] == pytest.approx(want[p][0], abs=1e-10) for p in want)


def test_pairs_of_long_series(spark):
    """More days than are dense at once, in more chunks than blocks."""
    panel = spark.range(450 * 600).selectExpr("id div 600 as code", "id % 600 as day", "pmod(xxhash64(id), 1000) / 100.0 as x")
    want = np.corrcoef(np.array([r.x for r in panel.orderBy("code", "day").collect()], float).reshape(450, 600))
    got = network.pair_correlations(panel, "x", 10, blocks=1).collect()
    assert len(got) == 450 * 449 // 2 and {r.n for r in got} == {600}
    assert max(abs(r.corr - want[r.i, r.j]) for r in got) < 1e-10


def test_nearest_with_ties(spark):
    """Copies tie at 1 within and between chunks: the smaller codes stay, as from the whole pair table."""
    panel = spark.range(2300 * 12).selectExpr("id div 12 as code", "id % 12 as day", "pmod(xxhash64(id div 12 % 300, id % 12), 1000) / 10.0 as x")
    got = sorted((r.i, r.j, r.place) for r in network.nearest(panel, "x", 10, 5, blocks=1).collect())
    want = sorted((r.i, r.j, r.place) for r in network.neighbours(network.pair_correlations(panel, "x", 10, blocks=3), 5).collect())
    assert got == want and len(got) == 2300 * 5
    assert [j for i, j, _ in got if i == 2299] == [199, 499, 799, 1099, 1399]


def test_rounding_of_ties(spark):
    """Ties are told in the same digits as Spark's round() does."""
    c = np.array([0.1234567885, 0.1234567895, -0.9999999995, 0.5000000005, 0.0000000005, 1.0000000000000002, 0.3])
    want = [round(abs(r.c) * 1e9) for r in spark.createDataFrame([(k, float(v)) for k, v in enumerate(c)], "k int, c double").selectExpr("k", "round(c, 9) as c").orderBy("k").collect()]
    assert network._nano(c).tolist() == want
