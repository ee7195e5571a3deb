"""Metrics as declared plans: specification, guards, dependency order and incremental maintenance."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cross import cs_rank
from ..sources.tables import Catalog


@dataclass(frozen=True)
class Metric:
    """A metric and what it needs. ``compute(ctx)`` returns (day, code, value), or (day, value) for the market."""

    name: str
    compute: Callable[[Context], DataFrame]
    reads: tuple[str, ...] = ()
    parents: tuple[str, ...] = ()
    warmup: int = 0  # sessions before the first day that it looks at
    market: bool = False
    label: bool = False
    forward: int = 0  # sessions that a label looks ahead
    accepts_delay: bool = False  # it shifts late tables itself
    align: float | None = None  # fill before its first true day


class Registry:
    """Metrics by name; everything that can be refused is refused on registration."""

    def __init__(self, catalog: Catalog, builders: dict[str, Callable[[dict], Metric]] | None = None):
        self.catalog, self.metrics, self.builders = catalog, {}, builders or {}

    def add(self, metric: Metric) -> Metric:
        if metric.name in self.metrics:
            raise ValueError(f"{metric.name} is registered already")
        for name in metric.reads:
            d = self.catalog.datasets.get(name)
            if d is None:
                raise ValueError(f"{metric.name} reads {name}, which the catalogue lacks")
            if d.adjusted:
                raise ValueError(f"{metric.name} reads {name}, which is rewritten in hindsight")
            if d.delay and not metric.accepts_delay:
                raise ValueError(f"{metric.name} must shift {name} by {d.delay} sessions")
        if metric.forward and not metric.label:
            raise ValueError(f"{metric.name} looks ahead and is no label")
        self.metrics[metric.name] = metric
        return metric

    def metric(self, name: str, **declared) -> Callable:
        """Decorator that registers a compute function."""
        return lambda f: (self.add(Metric(name, f, **declared)), f)[1]

    def build(self, specs: list[dict]) -> list[Metric]:
        """Metrics from (builder, parameters) specifications; only known builders are run."""
        for s in specs:
            if s["builder"] not in self.builders:
                raise ValueError(f"unknown builder {s['builder']}")
        return [self.add(self.builders[s["builder"]](s.get("parameters", {}))) for s in specs]

    def order(self, names: list[str]) -> list[Metric]:
        """The metrics and all their parents, parents first."""
        done: dict[str, Metric] = {}
        path: list[str] = []

        def visit(name: str):
            if name in done:
                return
            if name in path:
                raise ValueError(f"{' -> '.join([*path[path.index(name) :], name])} is a circle")
            path.append(name)
            for p in self.metrics[name].parents:
                visit(p)
            path.pop()
            done[name] = self.metrics[name]

        for n in names:
            visit(n)
        return list(done.values())

    def starts(self, names: list[str], start: int) -> dict[str, int]:
        """First session that each metric must have, so that its children's warm-ups are covered."""
        first = dict.fromkeys(names, start)
        for m in reversed(self.order(names)):
            own = first.setdefault(m.name, start)
            for p in m.parents:
                first[p] = min(first.get(p, own), own - m.warmup)
        return first


class Context:
    """What a metric may read: the declared tables, and the parents' results."""

    def __init__(self, registry: Registry, metric: Metric, grid: DataFrame, results: dict[str, DataFrame]):
        self._registry, self._metric, self.grid, self._results = registry, metric, grid, results

    def table(self, name: str, **scan) -> DataFrame:
        if name not in self._metric.reads:
            raise PermissionError(f"{self._metric.name} reads {name} without declaring it")
        return self._registry.catalog.scan(name, **scan)

    def parent(self, name: str) -> DataFrame:
        if name not in self._metric.parents:
            raise PermissionError(f"{self._metric.name} uses {name} without declaring it")
        return self._results[name]


def product(metric: Metric, computed: DataFrame, universe: DataFrame | None, least: int = 100) -> DataFrame:
    """The stored form: (day, code, value, rank) or (day, value), floats; rows without a value are kept."""
    want = ["day", "value"] if metric.market else ["day", "code", "value"]
    if sorted(computed.columns) != sorted(want):
        raise ValueError(f"{metric.name} gives {computed.columns}, not {want}")
    if metric.market:
        return computed.select("day", F.col("value").cast("float").alias("value"))
    inside = computed
    if universe is not None:
        inside = computed.join(universe.select("day", "code", F.lit(True).alias("__in")), ["day", "code"], "left").withColumn("value", F.when(F.col("__in"), F.col("value"))).drop("__in")
    ranked = inside.withColumn("rank", F.lit(None).cast("double")) if metric.label else cs_rank(inside, "value", "rank", least)
    return ranked.select("day", "code", F.col("value").cast("float").alias("value"), F.col("rank").cast("float").alias("rank"))


def run(registry: Registry, names: list[str], grid: DataFrame, universe: DataFrame | None = None, least: int = 100) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Plans of all metrics, parents first; a metric whose parent failed is blocked, the others go on.

    Returned are lazy plans: metrics that share their sources and windows share exchanges.
    """
    raw: dict[str, DataFrame] = {}
    out: dict[str, DataFrame] = {}
    failed: dict[str, str] = {}
    for m in registry.order(names):
        blocked = [p for p in m.parents if p in failed]
        if blocked:
            failed[m.name] = f"blocked by {blocked[0]}"
            continue
        try:
            raw[m.name] = m.compute(Context(registry, m, grid, raw))
            out[m.name] = product(m, raw[m.name], universe, least)
        except Exception as e:
            failed[m.name] = f"{type(e).__name__}: {e}"
    return out, failed


def plan_days(days: DataFrame, have: DataFrame, expected: DataFrame | None = None, tail: int = 0, refresh: bool = False) -> DataFrame:
    """Sessions to compute: missing ones, those with fewer rows than expected, and the last ``tail`` ones."""
    from ..operators.grid import calendar

    sessions = calendar(days).select("day", "session")
    if refresh:
        return sessions.select("day")
    last = sessions.agg(F.max("session").alias("__last"))
    seen = have.groupBy("day").agg(F.count(F.lit(1)).alias("__n"))
    want = sessions.join(seen, "day", "left").join(F.broadcast(last))
    short = F.lit(False)
    if expected is not None:
        want = want.join(expected.select("day", F.col("n_rows").alias("__want")), "day", "left")
        short = F.col("__n") < F.coalesce("__want", F.lit(0))
    return want.where(F.col("__n").isNull() | short | (F.col("session") > F.col("__last") - tail)).select("day")


def freeze(plan: DataFrame, covered: DataFrame, end: str, revision_days: int = 10) -> tuple[DataFrame, DataFrame]:
    """(days to compute, days refused): covered days older than the revision window are history."""
    floor = F.date_sub(F.lit(end).cast("date"), revision_days)
    known = covered.select("day").distinct().withColumn("__c", F.lit(True))
    marked = plan.join(known, "day", "left").withColumn("__old", F.coalesce("__c", F.lit(False)) & (F.col("day") < floor))
    return marked.where(~F.col("__old")).select("day"), marked.where("__old").select("day")


def align(df: DataFrame, days: DataFrame, codes: DataFrame, fill: float | None) -> DataFrame:
    """``df`` (day, code, value) with rows for all sessions before its first, filled with ``fill``."""
    from ..operators.grid import build

    first = df.agg(F.min("day").alias("__first"))
    early = build(days, codes).join(F.broadcast(first)).where("day < __first").select("day", "code", F.lit(fill).cast("double").alias("value"))
    return df.select("day", "code", "value").unionByName(early)


def wide_snapshot(products: dict[str, DataFrame], least: int = 100, flip: set[str] = frozenset()) -> DataFrame:
    """One column for each metric, each standardised within its day, over the union of all (day, code).

    Metrics come as long rows of one table and are pivoted in one shuffle, not joined one by one.
    """
    from ..functions.cross import standardize
    from ..operators.grid import to_wide

    long = None
    for name, df in products.items():
        part = standardize(df.select("day", "code", F.col("value").cast("double").alias("value")), "value", "z", least, flip=name in flip).select("day", "code", F.lit(name).alias("name"), "z")
        long = part if long is None else long.unionByName(part)
    return to_wide(long, "name", "z", ["day", "code"], list(products))


def feature_sets(coverage: DataFrame, least: float = 0.005) -> DataFrame:
    """Names whose coverage reaches ``least`` in every year there is."""
    return coverage.groupBy("name").agg(F.min("coverage").alias("lowest")).where(F.col("lowest") >= least)


def execute(registry: Registry, names: list[str], grid: DataFrame, store: str, universe: DataFrame | None = None, least: int = 100, resume: bool = False) -> list[tuple[str, str, str]]:
    """Compute and store the products of all metrics, parents first: (name, state, what) of each.

    Each metric is written to ``store`` before its children are computed, and children read the parent's file,
    so no plan is computed twice and a failure at run time is seen where it happens: it is ``failed``, its
    children are ``blocked`` and the others go on. With ``resume``, metrics that stand in the store are
    ``kept``: a product's file is there only when it was written whole.
    """
    spark = grid.sparkSession
    raw: dict[str, DataFrame] = {}
    state: dict[str, tuple[str, str]] = {}
    for m in registry.order(names):
        blocked = [p for p in m.parents if state[p][0] in ("failed", "blocked")]
        if blocked:
            state[m.name] = ("blocked", blocked[0])
            continue
        kept = stored(spark, store, m.name) if resume else None
        if kept is not None:
            raw[m.name], state[m.name] = kept.drop("rank"), ("kept", "")
            continue
        try:
            done = product(m, m.compute(Context(registry, m, grid, raw)), universe, least)
            done.write.mode("overwrite").option("compression", "zstd").parquet(f"{store}/{m.name}")
            raw[m.name] = stored(spark, store, m.name).drop("rank")
            state[m.name] = ("done", "")
        except Exception as e:  # the reason is told; the other metrics go on
            state[m.name] = ("failed", f"{type(e).__name__}: {str(e).splitlines()[0][:200] if str(e) else ''}")
    return [(name, *what) for name, what in state.items()]


def stored(spark, store: str, name: str) -> DataFrame | None:
    """A metric's product in the store, or None."""
    try:
        return spark.read.parquet(f"{store}/{name}")
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def axes(products: dict[str, DataFrame]) -> DataFrame:
    """(day, code) that any of the products has."""
    parts = [df.select("day", "code") for df in products.values()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()
