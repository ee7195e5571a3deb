"""Queries without SQL, held against loops over the same rows."""

import datetime
import itertools
import math

import numpy as np
import pytest

from panelloom import queries
from panelloom.operators import bitemporal, evaluation, network, recursive
from panelloom.streaming import increments
from tests.test_queries_against_sql import SF_DIR, pytestmark  # noqa: F401


def histories(df, order, *columns):
    """{code: [(order, columns…)]} in order."""
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["code"], r[order])):
        out.setdefault(r["code"], []).append((r[order], *[r[c] for c in columns]))
    return out


def check(rows, key, value, want):
    got = {tuple(r[k] for k in key): r[value] for r in rows}
    assert set(got) == set(want)
    n = 0
    for k, v in want.items():
        assert (got[k] is None) == (v is None), (k, got[k], v)
        if v is not None:
            assert got[k] == pytest.approx(v, abs=2e-5), k
            n += 1
    assert n


def test_rolling_ols(spark):
    from pyspark.sql import functions as F

    panel = queries.panel(spark, SF_DIR).withColumn("t", F.sin(F.dayofyear("day")))
    want = {}
    for code, rows in histories(panel, "day", "x", "y", "t").items():
        for i, (day, *_) in enumerate(rows):
            window = [r[1:] for r in rows[max(0, i - 9) : i + 1]]
            value = None
            if len(window) == 10 and all(v is not None for r in window for v in r):
                a = np.array([[1.0, r[1], r[2]] for r in window])
                y = np.array([r[0] for r in window])
                value = float(y[-1] - a[-1] @ np.linalg.lstsq(a, y, rcond=None)[0])
            want[code, day] = value
    check(queries.QUERIES["w24_rolling_ols"](spark, SF_DIR).collect(), ("code", "day"), "residual", want)


def test_first_passage(spark):
    want = {}
    for code, rows in histories(queries.panel(spark, SF_DIR), "day", "x").items():
        for i, (day, _) in enumerate(rows):
            window = [r[1] for r in rows[max(0, i - 12) : i + 1]]
            value = None
            if len(window) == 13 and None not in window:
                value = np.mean([next((k for k in range(1, 6) if window[s + k] - window[s] >= 0.5), 5) for s in range(8)])
            want[code, day] = value
    check(queries.QUERIES["w28_first_passage"](spark, SF_DIR).collect(), ("code", "day"), "passage", want)


def test_prospect_value(spark):
    weigh = lambda p, c: p**c / (p**c + (1 - p) ** c) ** (1 / c)
    want = {}
    for code, rows in histories(queries.panel(spark, SF_DIR), "day", "x").items():
        for i, (day, _) in enumerate(rows):
            window = [r[1] for r in rows[max(0, i - 11) : i + 1]]
            value = None
            if len(window) == 12 and None not in window:
                value = 0.0
                for k, v in enumerate(sorted(x - 8.0 for x in window), 1):
                    if v < 0:
                        value += (weigh(k / 12, 0.69) - weigh((k - 1) / 12, 0.69)) * -2.25 * abs(v) ** 0.88
                    else:
                        value += (weigh((13 - k) / 12, 0.61) - weigh((12 - k) / 12, 0.61)) * v**0.88
            want[code, day] = value
    check(queries.QUERIES["w29_prospect_value"](spark, SF_DIR).collect(), ("code", "month"), "worth", want)


def test_seasonal_innovation(spark):
    rows = [(c, p, None if (c, p) == (2, 9) else math.log(50 + 3 * p + 7 * (p % 4) + (37 * p * c % 11))) for c in (1, 2, 3) for p in range(10 * c)]
    got = recursive.seasonal_innovation(spark.createDataFrame(rows, "code long, period long, x double"), "x", "innovation").collect()
    want = {}
    for code, own in itertools.groupby(rows, key=lambda r: r[0]):
        own = list(own)
        for i, (_, p, v) in enumerate(own):
            past = own[max(0, i - 12) : i]
            value = None
            if len(past) == 12 and v is not None and all(r[2] is not None for r in past):
                line = lambda q: [1.0, q - past[0][1], *[float(q % 4 == s) for s in (1, 2, 3)]]
                a, y = np.array([line(r[1]) for r in past]), np.array([r[2] for r in past])
                beta = np.linalg.lstsq(a, y, rcond=None)[0]
                value = float((v - np.array(line(p)) @ beta) / np.sqrt(((y - a @ beta) ** 2).sum() / 7))
            want[code, p] = value
    check(got, ("code", "period"), "innovation", want)
    assert {r.code for r in queries.QUERIES["w25_seasonal_innovation"](spark, SF_DIR).collect()}


def test_trailing_year_before(spark):
    v = queries.vintages(spark, SF_DIR)
    events = bitemporal.revision_events(v).collect()
    known = {}
    for r in sorted(v.collect(), key=lambda r: r["pit"]):
        known.setdefault((r["code"], r["period"]), []).append((r["pit"], r["val"]))

    def at(code, period, pit):
        return next((x for p, x in reversed(known.get((code, period), [])) if p <= pit), None)

    want = {}
    for e in events:
        cum = [at(e["code"], e["period"] - 4 - k, e["pit"]) for k in range(8)]
        q = (e["period"] - 4) % 4
        parts = [cum[0]] if q == 3 else [cum[0], cum[q + 1], cum[4]]
        value = None if None in parts else cum[0] if q == 3 else cum[0] + cum[q + 1] - cum[4]
        if value is None:
            single = [None if cum[k] is None or (e["period"] - 4 - k) % 4 and cum[k + 1] is None else cum[k] - (cum[k + 1] if (e["period"] - 4 - k) % 4 else 0) for k in range(4)]
            value = None if None in single else sum(single)
        want[e["code"], e["period"], e["pit"]] = value
    got = queries.QUERIES["f03_lagged_trailing_year"](spark, SF_DIR).collect()
    check(got, ("code", "period", "pit"), "value", want)


def test_eigen_centrality(spark):
    edges = queries.whole_edges(spark, SF_DIR).collect()
    codes = sorted({c for r in edges for c in (r["i"], r["j"])})
    place = {c: k for k, c in enumerate(codes)}
    a = np.zeros((len(codes), len(codes)))
    for r in edges:
        a[place[r["i"]], place[r["j"]]] += abs(r["corr"])
    score = np.ones(len(codes))
    for _ in range(10):
        score = a @ score
    got = {r.code: r.score for r in network.eigen_centrality(queries.whole_edges(spark, SF_DIR)).collect()}
    best = score.max()
    assert all(got[c] == pytest.approx(score[place[c]] / best, abs=1e-5) for c in got) and max(got.values()) == pytest.approx(1.0)


def brute_ledger(rows, cash, hold, band, lot):
    fee = lambda amount, selling: max(amount * 0.00025, 5.0) + amount * 1e-5 + (amount * 5e-4 if selling else 0)
    held, last, out = {}, {}, []
    for day, today in itertools.groupby(sorted(rows, key=lambda r: (r[0], r[2], r[1])), key=lambda r: r[0]):
        today = list(today)
        by_code = {r[1]: r for r in today}
        for code in sorted(held):
            r = by_code.get(code)
            if r and r[2] > band and r[5]:
                cash += held[code] * r[3] - fee(held[code] * r[3], True)
                del held[code]
        for _, code, place, price, buy, _ in today:
            if place <= hold and len(held) < hold and code not in held and buy:
                n = int(cash / (hold - len(held)) / (price * lot))
                while n > 0 and n * lot * price + fee(n * lot * price, False) > cash:
                    n -= 1
                if n > 0:
                    cash -= n * lot * price + fee(n * lot * price, False)
                    held[code] = n * lot
        last |= {r[1]: r[3] for r in today}
        out.append((day, cash + sum(k * last[c] for c, k in held.items()), len(held)))
    return out


def test_cash_ledger(spark):
    import random

    r = random.Random(4)
    rows = []
    for k in range(20):
        day = datetime.date(2024, 1, 1) + datetime.timedelta(days=k)
        for place, code in enumerate(r.sample(range(30), 25), 1):
            rows.append((day, code, place, round(r.uniform(3, 60), 2), r.random() < 0.9, r.random() < 0.9))
    df = spark.createDataFrame([("s", *x) for x in rows], "strategy string, day date, code long, place long, price double, can_buy boolean, can_sell boolean")
    got = [(x.day, x.value, x.n_held) for x in evaluation.cash_ledger(df, 200_000.0, 5, 10).orderBy("day").collect()]
    want = brute_ledger(rows, 200_000.0, 5, 10, 100)
    assert [(d, n) for d, _, n in got] == [(d, n) for d, _, n in want]
    assert [v for _, v, _ in got] == pytest.approx([v for _, v, _ in want])


def test_archive_refuses_other_scores(spark, tmp_path):
    df = spark.createDataFrame([(datetime.date(2024, 1, d), c, d * c) for d in (1, 2) for c in (3, 4)], "day date, code long, score long")
    evaluation.archive_scores(df, str(tmp_path), "a", ["score"])
    evaluation.archive_scores(df, str(tmp_path), "b", ["score"])
    with pytest.raises(ValueError):
        evaluation.archive_scores(df.selectExpr("day", "code", "score + 1 AS score"), str(tmp_path), "a", ["score"])
    assert spark.read.parquet(f"{tmp_path}/scores").count() == 8


def test_field_kinds():
    fields = {"revenue": bitemporal.CUMULATIVE, "assets": bitemporal.POINT, "margin": bitemporal.RATIO}
    assert bitemporal.require_kind(fields, "revenue", "trailing") == "revenue" and bitemporal.require_kind(fields, "margin", "as_is") == "margin"
    for field, use in (("margin", "trailing"), ("margin", "point"), ("assets", "quarter"), ("none", "point")):
        with pytest.raises(ValueError):
            bitemporal.require_kind(fields, field, use)


def test_token_bucket():
    clock = [0.0]
    bucket = increments.TokenBucket(2.0, 3, lambda: clock[0])
    assert [bucket.wait_for() for _ in range(5)] == [0.0, 0.0, 0.0, 0.5, 1.0]
    clock[0] = 10.0
    assert [bucket.wait_for(3), bucket.wait_for()] == [0.0, 0.5]


def test_write_buffer_grows_with_the_table(spark):
    from panelloom.sources import tables

    sizes = []
    buffer = tables.WriteBuffer(lambda df: sizes.append(df.count()), least=4, share=0.5)
    for _ in range(20):
        buffer.add(spark.range(2))
    buffer.flush()
    assert sum(sizes) == 40 and sizes == [4, 4, 4, 6, 10, 12] and buffer.flushes == 6
