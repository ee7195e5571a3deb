"""The registry that executes, its command line, and metrics by builders."""

import datetime

import pytest
from pyspark.sql import functions as F

from panelloom import cli
from panelloom.plans import metrics, registry
from panelloom.sources import tables


def build(spark):
    reg = registry.Registry(tables.Catalog(spark, ""))
    reg.add(metrics.metric("move", "difference", {"x": "x", "n": 2}, warmup=2))
    reg.add(registry.Metric("calm", lambda ctx: ctx.parent("move").select("day", "code", (-F.abs("value")).alias("value")), parents=("move",)))
    return reg


def build_broken(spark):
    reg = build(spark)
    reg.add(registry.Metric("broken", lambda ctx: ctx.grid.select("day", "code", F.raise_error(F.lit("no such price")).cast("double").alias("value"))))
    reg.add(registry.Metric("child", lambda ctx: ctx.parent("broken"), parents=("broken",)))
    return reg


@pytest.fixture
def grid(spark, tmp_path):
    rows = [(datetime.date(2024, 1, 1) + datetime.timedelta(days=d), c, float(d * c % 7)) for d in range(12) for c in range(1, 6)]
    spark.createDataFrame(rows, "day date, code long, x double").write.parquet(f"{tmp_path}/grid")
    return f"{tmp_path}/grid"


def test_command_line(spark, grid, tmp_path, capsys):
    call = lambda build, *more: cli.main(["--registry", f"tests.test_registry_execution:{build}", "--grid", grid, "--store", f"{tmp_path}/store", "--least", "2", *more], spark)
    told = lambda: [line.split("\t") for line in capsys.readouterr().out.splitlines()]
    assert call("build", "list") == 0 and told() == [["move", "metric", "-"], ["calm", "metric", "move"]]
    assert call("build", "status") == 0 and [r[1] for r in told()] == ["missing", "missing"]
    assert call("build", "--dry-run", "run") == 0 and [r[1] for r in told()] == ["compute", "compute"]
    assert call("build", "--end", "2024-01-10", "run", "move") == 0 and [r[:2] for r in told()] == [["move", "done"]]
    assert call("build", "run") == 0 and [r[:2] for r in told()] == [["move", "kept"], ["calm", "done"]]
    assert call("build_broken", "run") == 1 and [r[:2] for r in told()] == [["move", "kept"], ["calm", "kept"], ["broken", "failed"], ["child", "blocked"]]
    assert call("build", "rebuild", "move") == 0 and [r[:2] for r in told()] == [["move", "done"]]
    assert call("build", "status") == 0 and told() == [["move", "60 rows until 2024-01-12"], ["calm", "50 rows until 2024-01-10"]]


def test_products_equal_the_lazy_plans(spark, grid, tmp_path):
    dense = spark.read.parquet(grid)
    registry.execute(build(spark), ["calm"], dense, f"{tmp_path}/p", least=2)
    lazy, failed = registry.run(build(spark), ["calm"], dense, least=2)
    rows = lambda df: sorted(map(tuple, df.select("day", "code", "value", "rank").collect()), key=str)
    assert not failed and rows(registry.stored(spark, f"{tmp_path}/p", "calm")) == rows(lazy["calm"])


def test_builders(spark):
    rows = [(c, datetime.date(2024, 1, 1) + datetime.timedelta(days=d), 10.0 + d * c, float(d % 4)) for c in (1, 2) for d in range(20)]
    df = spark.createDataFrame(rows, "code long, day date, x double, v double")
    got = metrics.together(df, [("c", "change", {"x": "x", "n": 1, "low": -0.05, "high": 0.05}), ("s", "surprise", {"x": "v", "n": 4, "least": 4}), ("p", "own_percentile", {"x": "x", "n": 5, "least": 5}), ("g", "growth", {"now": "x", "before": "v", "years": 2}), ("m", "memory", {"x": "v", "n": 12, "least": 6}), ("i", "illiquidity", {"ret": "v", "amount": "x", "n": 3, "least": 3}), ("r", "range_volatility", {"high": "x", "low": "v"})]).where("code = 2").orderBy("day").collect()
    assert got[1].c == pytest.approx(0.05) and got[19].c == pytest.approx(2 / 46) and got[3].s == pytest.approx(1.0) and got[4].s == pytest.approx(-1.0)
    assert got[19].p == 1.0 and got[3].p is None and got[1].g == pytest.approx(12**0.5 - 1) and got[4].g is None
    assert got[19].m == pytest.approx(-0.2, abs=0.2) and got[2].i == pytest.approx((0 + 1 / 12 + 2 / 14) / 3) and got[0].r is None
    with pytest.raises(ValueError):
        metrics.column("none", {})
