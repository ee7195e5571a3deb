"""Builders of panel metrics, by parameters: a metric is a column over a dense panel's rows.

Metrics that share a panel are computed together: their windows have one partition and one order, so all of
them come out of a single exchange and sort.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clamp, safe_div, safe_sqrt
from ..functions.windows import Series
from .registry import Metric

S = Series()
BUILDERS: dict[str, Callable[..., Column]] = {}


def builder(f: Callable[..., Column]) -> Callable[..., Column]:
    BUILDERS[f.__name__] = f
    return f


@builder
def difference(x: str, n: int) -> Column:
    """Change over n sessions."""
    return S.diff(F.col(x), n)


@builder
def change(x: str, n: int, low: float | None = None, high: float | None = None) -> Column:
    """Relative change over n sessions, within bounds where they are given."""
    c = S.pct_change(F.col(x), n)
    return c if low is None or high is None else clamp(c, low, high)


@builder
def acceleration(x: str, short: int, long: int) -> Column:
    """Change over the short span less that over the long one."""
    return S.diff(F.col(x), short) - S.diff(F.col(x), long)


@builder
def to_high(x: str, n: int, least: int | None = None) -> Column:
    """Distance from the highest value of n sessions, as a share of it."""
    return safe_div(F.col(x), S.max(F.col(x), n, least), 1e-12) - 1


@builder
def from_low(x: str, n: int, least: int | None = None) -> Column:
    return safe_div(F.col(x), S.min(F.col(x), n, least), 1e-12) - 1


@builder
def mean(x: str, n: int, least: int | None = None) -> Column:
    return S.mean(F.col(x), n, least)


@builder
def deviation(x: str, n: int, least: int | None = None) -> Column:
    return S.std(F.col(x), n, least)


@builder
def mean_ratio(x: str, short: int, long: int, least: tuple[int, int]) -> Column:
    """Mean of the short span over the mean of the long one."""
    return safe_div(S.mean(F.col(x), short, least[0]), S.mean(F.col(x), long, least[1]))


@builder
def surprise(x: str, n: int, least: int) -> Column:
    """Today's value over the mean of n sessions, less 1."""
    return safe_div(F.col(x), S.mean(F.col(x), n, least), 1e-12) - 1


@builder
def sum_ratio(x: str, y: str, n: int, least: int) -> Column:
    """Sum of x over the sum of y, both over n sessions."""
    return safe_div(S.sum(F.col(x), n, least), S.sum(F.col(y), n, least))


@builder
def illiquidity(ret: str, amount: str, n: int, least: int) -> Column:
    """Mean of |return| over amount."""
    return S.mean(safe_div(F.abs(F.col(ret)), F.col(amount)), n, least)


@builder
def memory(x: str, n: int, least: int) -> Column:
    """Correlation of a series with itself a session before."""
    return S.corr(F.col(x), S.shift(F.col(x), 1), n, least)


@builder
def range_volatility(high: str, low: str) -> Column:
    """Volatility of a day from its range: log(high / low) squared over 4 log 2, rooted."""
    ratio = F.log(safe_div(F.col(high), F.col(low), 1e-12))
    return safe_sqrt(ratio * ratio / (4 * F.log(F.lit(2.0))))


@builder
def volume_concentration(vol: str, squares: str, n_bars: str) -> Column:
    """Deviation of a day's bar volumes over their mean, from their sum, squares and number."""
    return safe_sqrt(F.greatest(F.col(n_bars) * safe_div(F.col(squares), F.col(vol) * F.col(vol)) - 1, F.lit(0.0)))


@builder
def own_percentile(x: str, n: int, least: int) -> Column:
    """Share of the series' own last n values below the newest."""
    return S.rank(F.col(x), n, least)


@builder
def growth(now: str, before: str, years: float) -> Column:
    """Compound growth a year between two positive figures."""
    ratio = F.when((F.col(now) > 0) & (F.col(before) > 0), F.col(now) / F.col(before))
    return F.pow(ratio, F.lit(1.0 / years)) - 1


@builder
def spread(a: str, b: str) -> Column:
    return F.col(a) - F.col(b)


def column(kind: str, parameters: dict) -> Column:
    if kind not in BUILDERS:
        raise ValueError(f"unknown builder {kind}")
    return BUILDERS[kind](**parameters)


def metric(name: str, kind: str, parameters: dict, warmup: int = 0, reads: tuple[str, ...] = ()) -> Metric:
    """A registered metric over the context's grid."""
    value = column(kind, parameters)
    return Metric(name, lambda ctx: ctx.grid.select("day", "code", value.cast("double").alias("value")), reads=reads, warmup=warmup)


def together(panel: DataFrame, specs: list[tuple[str, str, dict]]) -> DataFrame:
    """``panel``'s (code, day) with a column for each (name, builder, parameters): one pass for all."""
    return panel.select("code", "day", *[column(kind, parameters).alias(name) for name, kind, parameters in specs])
