"""Operators against plain Python on small fixtures, and properties that queries do not show."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelloom.functions import cross, scalar
from panelloom.functions.windows import Series
from panelloom.operators import bitemporal, evaluation, grid, network, recursive, sets
from panelloom.plans import registry
from panelloom.sources import tables
from panelloom.streaming import increments

DAY0 = dt.date(2024, 1, 1)


def day(n):
    return DAY0 + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def panel(spark):
    r = random.Random(3)
    rows = [(c, day(t), None if r.random() < 0.15 or (c == 2 and 5 <= t < 15) else 1.0 if c == 3 else round(r.choice([r.gauss(0, 1), 0.5]), 3)) for c in range(5) for t in range(30)]
    return spark.createDataFrame(rows, "code long, day date, x double"), rows


def by_code(rows):
    return {c: [x for k, _, x in rows if k == c] for c in {k for k, _, _ in rows}}


def compare(df, rows, column, fn):
    got = {(r.code, r.day): r.v for r in df.select("code", "day", column.alias("v")).collect()}
    for c, xs in by_code(rows).items():
        for t in range(len(xs)):
            want, have = fn(xs, t), got[(c, day(t))]
            assert (have is None) == (want is None) and (want is None or have == pytest.approx(want, abs=1e-9)), (c, t, want, have)


def window(xs, t, n, k):
    if t < n - 1:
        return None
    w = [x for x in xs[t - n + 1 : t + 1] if x is not None]
    return w if len(w) >= k else None


def test_windows_are_poisoned_or_relaxed(panel):
    df, rows = panel
    s, x = Series(), F.col("x")
    compare(df, rows, s.sum(x, 4), lambda xs, t: sum(w) if (w := window(xs, t, 4, 4)) else None)
    compare(df, rows, s.mean(x, 6, 2), lambda xs, t: float(np.mean(w)) if (w := window(xs, t, 6, 2)) else None)
    compare(df, rows, s.std(x, 6, 2), lambda xs, t: float(np.std(w)) if (w := window(xs, t, 6, 2)) else None)
    compare(df, rows, s.quantile(x, 6, 0.3, 2), lambda xs, t: float(np.quantile(w, 0.3)) if (w := window(xs, t, 6, 2)) else None)

    def skew(xs, t):
        w = window(xs, t, 8, 4)
        if not w or np.std(w) < 1e-12:
            return None
        n, d = len(w), np.array(w) - np.mean(w)
        return float((d**3).mean() / (d**2).mean() ** 1.5 * math.sqrt(n * (n - 1)) / (n - 2))

    compare(df, rows, s.skew(x, 8, 4), skew)


def test_ewm_holds_its_state(panel):
    df, rows = panel

    def brute(xs, t):
        s = None
        for v in xs[: t + 1]:
            if v is not None:
                s = v if s is None else s + 0.3 * (v - s)
        return s

    compare(df, rows, Series().ewm(F.col("x"), 0.3), brute)
    compare(recursive.ewm(df, "x", "e", 0.3), rows, F.col("e"), brute)


def test_rolling_fit(panel):
    df, rows = panel

    def brute(xs, t):
        if t < 7 or None in xs[t - 7 : t + 1]:
            return None
        y, a = np.array(xs[t - 7 : t + 1]), np.column_stack([np.ones(8), np.sin(np.arange(t - 7, t + 1)), np.cos(np.arange(t - 7, t + 1))])
        return float(y[-1] - a[-1] @ np.linalg.lstsq(a, y, rcond=None)[0])

    t = F.datediff("day", F.lit(DAY0))
    compare(recursive.rolling_ols(df.withColumn("a", F.sin(t)).withColumn("b", F.cos(t)), "x", ["a", "b"], 8), rows, F.col("residual"), brute)


def test_late_rows_do_not_change_the_past(panel):
    """Values up to a day are the same whether later days are there or not."""
    df, _ = panel
    s, x = Series(), F.col("x")
    columns = [s.mean(x, 5, 2), s.ewm(x, 0.2), s.rank(x, 6, 3), s.decay_linear(x, 4), s.ffill(x)]
    make = lambda d: d.select("code", "day", *[c.alias(f"c{i}") for i, c in enumerate(columns)]).where(F.col("day") <= day(18))
    assert sets.same_content(make(df), make(df.where(F.col("day") <= day(18))))


def test_rank_with_ties_and_thin_days(panel):
    df, rows = panel
    got = {(r.code, r.day): r.v for r in cross.cs_rank(df, "x", "v", 3).collect()}
    for t in range(30):
        xs = {c: x for c, d, x in rows if d == day(t) and x is not None}
        lo, hi = (np.quantile(list(xs.values()), [0.01, 0.99])) if xs else (0, 0)
        xs = {c: min(max(x, lo), hi) if lo < hi else x for c, x in xs.items()}
        for c in range(5):
            v = None if c not in xs or len(xs) < 3 else (sum(y < xs[c] for y in xs.values()) + (sum(y == xs[c] for y in xs.values()) + 1) / 2) / len(xs)
            assert got[(c, day(t))] == (None if v is None else pytest.approx(v))


def test_asof_null_disclosure_clears(spark):
    g = grid.build(spark.createDataFrame([(day(i),) for i in range(6)], "day date"), spark.createDataFrame([(1,), (2,)], "code long"))
    src = spark.createDataFrame([(1, day(1), 10, 1), (1, day(3), None, 1), (1, day(4), 7, 1), (1, day(4), 8, 2)], "code long, day date, v long, k long")
    got = {(r.code, r.day): r.v for r in grid.asof(g, src, ["v"], ["k"]).collect()}
    assert [got[(1, day(i))] for i in range(6)] == [None, 10, 10, None, 8, 8] and all(got[(2, day(i))] is None for i in range(6))
    strict = {(r.code, r.day): r.v for r in grid.asof(g, src, ["v"], ["k"], strict=True, max_age=1).collect()}
    assert [strict[(1, day(i))] for i in range(6)] == [None, None, 10, None, None, 8]


def test_duplicate_keys_are_refused(spark):
    df = spark.createDataFrame([(1, 2), (1, 3)], "a long, b long")
    with pytest.raises(ValueError):
        grid.check_unique(df, ["a"])
    grid.check_unique(df, ["a", "b"])


def test_late_correction_of_an_old_period(spark):
    v = spark.createDataFrame([(1, 4, day(0), 10), (1, 5, day(10), 20), (1, 4, day(20), 11)], "code long, period int, pit date, val long")
    front = {r.pit: r.period for r in bitemporal.frontier(v).collect()}
    assert front == {day(0): 4, day(10): 5}
    events = bitemporal.at_period(bitemporal.revision_events(v), v, "val", "before", 1)
    assert {r.pit: (r.period, r.before) for r in events.collect()} == {day(0): (4, None), day(10): (5, 10), day(20): (5, 11)}


def test_intervals_and_upsert(spark):
    spans = spark.createDataFrame([(1, day(0), day(2)), (1, day(3), day(4)), (1, day(1), day(9)), (1, day(12), day(12))], "k long, from_day date, to_day date")
    assert sorted(map(tuple, sets.merge_intervals(spans, ["k"]).collect())) == [(1, day(0), day(9)), (1, day(12), day(12))]
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k long, v string, gone long")
    new = spark.createDataFrame([(2, "c", 5), (3, "d", 5)], "k long, v string, extra long")
    out = {r.k: (r.v, r.gone, r.extra) for r in tables.upsert(old, new, ["k"], ["k"]).collect()}
    assert out == {1: ("a", 1, None), 2: ("c", None, 5), 3: ("d", None, 5)}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2023, 1), (2024, 2)], "year int, v int")
    path = str(tmp_path / "t")
    tables.write_partitions(df, path, sort_by=["v"])
    tables.write_partitions(spark.createDataFrame([(2024, 9)], "year int, v int"), path)
    assert sorted((r.year, r.v) for r in spark.read.parquet(path).collect()) == [(2023, 1), (2024, 9)]
    snap = str(tmp_path / "s")
    tables.replace_snapshot(spark.range(100).toDF("a"), snap)
    with pytest.raises(ValueError):
        tables.replace_snapshot(spark.range(80).toDF("a"), snap)
    with pytest.raises(ValueError):
        tables.check_contract(df, spark.range(1).schema)
    with pytest.raises(ValueError):
        tables.Catalog(spark, str(tmp_path)).scan("t", ["nothing"])


def test_registry_guards(spark, tmp_path):
    late, hind = tables.Dataset("late", ("k",), delay=1), tables.Dataset("hind", ("k",), adjusted=True)
    reg = registry.Registry(tables.Catalog(spark, str(tmp_path), [late, hind]))
    value = lambda ctx: ctx.grid.select("day", "code", F.col("x").alias("value"))
    for bad in (registry.Metric("a", value, reads=("late",)), registry.Metric("a", value, reads=("hind",)), registry.Metric("a", value, reads=("none",)), registry.Metric("a", value, forward=2)):
        with pytest.raises(ValueError):
            reg.add(bad)
    reg.add(registry.Metric("a", value, parents=("b",), warmup=5))
    with pytest.raises(ValueError):
        reg.add(registry.Metric("a", value))
    reg.add(registry.Metric("b", value, parents=("a",)))
    with pytest.raises(ValueError, match="circle"):
        reg.order(["a"])
    reg2 = registry.Registry(tables.Catalog(spark, str(tmp_path)))
    reg2.add(registry.Metric("p", lambda ctx: ctx.table("hidden")))
    reg2.add(registry.Metric("q", value, parents=("p",), warmup=3))
    reg2.add(registry.Metric("r", value))
    g = spark.createDataFrame([(day(0), 1, 2.0)], "day date, code long, x double")
    out, failed = registry.run(reg2, ["q", "r"], g, least=1)
    assert set(out) == {"r"} and failed["q"] == "blocked by p" and "PermissionError" in failed["p"]
    assert reg2.starts(["q"], 100) == {"q": 100, "p": 97}
    assert out["r"].dtypes == [("day", "date"), ("code", "bigint"), ("value", "float"), ("rank", "float")]


def test_history_is_frozen(spark):
    plan = spark.createDataFrame([(day(0),), (day(20),), (day(25),)], "day date")
    covered = spark.createDataFrame([(day(0),), (day(25),)], "day date")
    do, refused = registry.freeze(plan, covered, str(day(30)), 10)
    assert sorted(r.day for r in do.collect()) == [day(20), day(25)] and [r.day for r in refused.collect()] == [day(0)]


def test_increment_equals_rebuild(spark, tmp_path):
    r = random.Random(5)
    rows = [(r.randrange(9), day(i % 7), i) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, day date, v long")
    t = increments.UpsertTable(spark, str(tmp_path / "u"), ["k", "day"], ["v"], "day")
    for n in range(3):
        part = df.where(F.col("v").between(n * 20, n * 20 + 19))
        t.merge(part, n)
        t.merge(part, n)  # given again after a failure
    assert t.last_batch() == 2
    assert sets.same_content(t.read().select("k", "day", "v"), sets.keep_last(df, ["k", "day"], ["v"]))


def test_gate():
    tries = {"a": iter([False, True]), "b": iter([False]), "c": iter([])}
    state = increments.gate(lambda t: next(tries[t]), {"a": "wait", "b": "watch", "c": "skip"}, lambda: None, 3)
    assert state == {"a": "ready", "b": "late", "c": "skipped"}
    with pytest.raises(TimeoutError):
        increments.gate(lambda t: False, {"a": "wait"}, lambda: None, 2)


def test_ledger(spark):
    ranked = spark.createDataFrame([("s", day(t), c, 1 + (c + t) % 3, 10.0 + c, True, True) for t in range(4) for c in range(3)], "strategy string, day date, code long, place int, price double, can_buy boolean, can_sell boolean")
    out = sorted(evaluation.cash_ledger(ranked, 100_000.0, hold=1, band=1).collect(), key=lambda r: r.day)
    assert [r.n_held for r in out] == [1, 1, 1, 1]
    lots = int(100_000 / (10.0 * 100))
    while lots * 1000 + max(lots * 1000 * 0.00025, 5) + lots * 1000 * 1e-5 > 100_000:
        lots -= 1
    assert out[0].cash == pytest.approx(100_000 - lots * 1000 - max(lots * 1000 * 0.00025, 5) - lots * 1000 * 1e-5)
    assert out[0].value == pytest.approx(out[0].cash + lots * 1000)


def test_ridge_and_clusters(spark):
    r = np.random.default_rng(1)
    a = r.normal(size=(200, 2))
    df = spark.createDataFrame([(float(u), float(v), float(3 + 2 * u - v)) for u, v in a], "u double, v double, y double")
    assert evaluation.ridge(df, "y", ["u", "v"], 0.0) == pytest.approx([3, 2, -1])
    pairs = spark.createDataFrame([("a", "b", 0.95), ("a", "c", 0.1), ("b", "c", 0.2)], "i string, j string, corr double")
    got = network.clusters(pairs, 0.2)
    assert got["a"] == got["b"] != got["c"]


def test_scalars(spark):
    row = spark.createDataFrame([(float("nan"), float("inf"), 0.0, "3/4", "9:05", "2024-01-02 x")], "a double, b double, z double, f string, c string, d string").select(
        scalar.fin("a"), scalar.fin("b"), scalar.safe_div(F.lit(1.0), "z"), scalar.fraction("f"), scalar.clock("c"), scalar.parse_day("d"), scalar.clamp(F.lit(None).cast("double"), 0, 1), scalar.normal_quantile(F.lit(0.975)), scalar.price_limit(F.lit(10.05))
    ).first()
    assert list(row)[:7] == [None, None, None, 0.75, 905, dt.date(2024, 1, 2), None]
    assert row[7] == pytest.approx(1.96, abs=1e-3) and row[8] == math.floor(10.05 * 1.1 * 100 + 0.5) / 100


def _fetch(dataset, params, offset, limit):
    rows = [{"code": c, "v": i} for i, c in enumerate(params["codes"] * 7)]
    return rows[offset : offset + limit], len(rows)


def test_paged_source(spark):
    import json
    import pickle

    from panelloom.sources import paged

    spark.dataSource.register(paged.PagedSource)
    reader = spark.read.format("paged").schema("code string, v long").options(dataset="d", ranges=json.dumps(paged.entity_ranges(["a", "b", "c"], 2)), page="4")
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(__import__(__name__, fromlist=["x"]))
    got = reader.option("fetch", cloudpickle.dumps(_fetch).hex()).load()
    assert got.groupBy("code").count().orderBy("code").collect() == [("a", 7), ("b", 7), ("c", 7)]
    short = lambda d, p, o, n: ([], 5)
    with pytest.raises(OSError):
        list(paged.read_pages(short, "d", {}, 3))
    assert paged.date_ranges(["1", "2", "3"], 2) == [{"start": "1", "end": "2"}, {"start": "3", "end": "3"}] and pickle
