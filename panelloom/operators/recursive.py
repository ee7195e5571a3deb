"""Operators that carry a state along each code's rows, in one pass over its sorted rows.

Rows are dealt by code and sorted within partitions. Batches stream through Arrow; a code's input columns
become NumPy arrays (its history: as many values as sessions), and the operator runs on these at once.
What a window or a fold of built-ins expresses is no such operator: see ``functions.windows``.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _numbers(column: pa.Array) -> np.ndarray:
    """Values as floats, NULL as NaN."""
    return column.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)


def _by_code(df: DataFrame, order: list[str], inputs: list[str], compute: Callable[..., np.ndarray], out: str) -> DataFrame:
    """``df`` with ``out``: ``compute`` of each code's input columns in order, NaN where it has no value."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    code_at, at = df.columns.index("code"), [df.columns.index(c) for c in inputs]

    def run(batches):
        held: list[pa.RecordBatch] = []  # the rows of the last code so far

        def flush():
            columns = [np.concatenate([_numbers(b.column(i)) for b in held]) for i in at]
            values = compute(*columns)
            begin = 0
            for b in held:
                own = values[begin : begin + b.num_rows]
                begin += b.num_rows
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own, pa.float64(), mask=np.isnan(own))], names=[*b.schema.names, out])
            held.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            codes = batch.column(code_at).to_pylist()
            cuts = [0, *[i for i in range(1, len(codes)) if codes[i] != codes[i - 1]], len(codes)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if held and held[-1].column(code_at)[-1].as_py() != codes[a]:
                    yield from flush()
                held.append(batch.slice(a, b - a))
        if held:
            yield from flush()

    return df.repartition("code").sortWithinPartitions("code", *order).mapInArrow(run, f"{schema}, `{out}` double")


def _windows(x: np.ndarray, n: int) -> np.ndarray:
    """(rows, n): the n values up to each row, NaN before the first."""
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([np.full(n - 1, np.nan), x]), n)


def ewm(df: DataFrame, x: str, out: str, alpha: float, least: int = 1, day: str = "day") -> DataFrame:
    """Recursive exponential mean: a missing value leaves the state; NULL until ``least`` values are seen."""

    def compute(values: np.ndarray) -> np.ndarray:
        result = np.full(len(values), np.nan)
        at = np.flatnonzero(~np.isnan(values))
        state, states = None, []
        for v in values[at].tolist():
            state = v if state is None else state + alpha * (v - state)
            states.append(state)
        if len(at) >= least:
            seen = np.cumsum(~np.isnan(values))
            known = seen >= max(least, 1)
            result[known] = np.array(states)[seen[known] - 1]
        return result

    return _by_code(df, [day], [x], compute, out)


def hysteresis(df: DataFrame, risk: str, out: str, high: float, low: float, reduced: float = 0.5, order: str = "day") -> DataFrame:
    """Budget that falls to ``reduced`` when the risk is over ``high`` and is whole again below ``low``.

    The state is what the last risk over ``high`` or below ``low`` says, so a window tells it.
    """
    said = F.when(F.col(risk) > high, F.lit(reduced)).when(F.col(risk) < low, F.lit(1.0))
    w = Window.partitionBy("code").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.coalesce(F.last(said, ignorenulls=True).over(w), F.lit(1.0)))


def market_risk(df: DataFrame, weights: dict[str, float], intercept: float, out: str = "risk") -> DataFrame:
    """Logistic risk of the weighted inputs; NULL unless all are there."""
    score = sum((w * F.col(c) for c, w in weights.items()), F.lit(float(intercept)))
    return df.withColumn(out, 1 / (1 + F.exp(-score)))


def _fit(design: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Least-squares coefficients of each (n, k) design of a stack, least in norm where one is singular."""
    return np.matmul(np.linalg.pinv(design), y[..., None])[..., 0]


def rolling_ols(df: DataFrame, y: str, xs: list[str], n: int, out: str = "residual", day: str = "day") -> DataFrame:
    """Residual of each row from the least-squares fit (with intercept) of its window of n rows; NULL unless complete."""

    def compute(target: np.ndarray, *regressors: np.ndarray) -> np.ndarray:
        result = np.full(len(target), np.nan)
        windows = np.stack([_windows(v, n) for v in (target, *regressors)], axis=-1)
        full = np.flatnonzero(~np.isnan(windows).any(axis=(1, 2)))
        if len(full):
            design = np.concatenate([np.ones((len(full), n, 1)), windows[full, :, 1:]], axis=-1)
            beta = _fit(design, windows[full, :, 0])
            result[full] = windows[full, -1, 0] - (design[:, -1] * beta).sum(axis=1)
        return result

    return _by_code(df, [day], [y, *xs], compute, out)


def seasonal_innovation(df: DataFrame, x: str, out: str, n: int = 12, season: int = 4, period: str = "period") -> DataFrame:
    """Deviation of each quarter from the line-plus-season forecast of the n quarters before, in residual deviations."""

    def compute(periods: np.ndarray, values: np.ndarray) -> np.ndarray:
        result = np.full(len(values), np.nan)
        rows = np.arange(n, len(values))
        if not len(rows):
            return result
        past_p, past_v = _windows(periods, n)[rows - 1], _windows(values, n)[rows - 1]
        good = ~np.isnan(past_v).any(axis=1) & ~np.isnan(values[rows])
        rows, past_p, past_v = rows[good], past_p[good], past_v[good]
        if not len(rows):
            return result
        design = lambda q: np.stack([np.ones_like(q), q - past_p[:, :1], *[(q % season == s).astype(float) for s in range(1, season)]], axis=-1)
        before = design(past_p)
        beta = _fit(before, past_v)
        spread = np.sqrt(((past_v - np.matmul(before, beta[..., None])[..., 0]) ** 2).sum(axis=1) / max(1, n - season - 1))
        forecast = (design(periods[rows][:, None])[:, 0] * beta).sum(axis=1)
        told = spread > 1e-12
        result[rows[told]] = (values[rows] - forecast)[told] / spread[told]
        return result

    return _by_code(df, [period], [period, x], compute, out)


def prospect_value(df: DataFrame, x: str, out: str, n: int = 60, alpha: float = 0.88, loss: float = 2.25, gain_weight: float = 0.61, loss_weight: float = 0.69, order: str = "month") -> DataFrame:
    """Cumulative-prospect value of the last n values: sorted outcomes under inverse-S probability weights."""

    def weigh(p, c):
        return p**c / (p**c + (1 - p) ** c) ** (1 / c)

    i = np.arange(1, n + 1)
    lower = weigh(i / n, loss_weight) - weigh((i - 1) / n, loss_weight)
    upper = weigh((n - i + 1) / n, gain_weight) - weigh((n - i) / n, gain_weight)

    def compute(values: np.ndarray) -> np.ndarray:
        v = np.sort(_windows(values, n), axis=1)  # NaN goes last
        worth = np.where(v < 0, -loss * np.abs(v) ** alpha * lower, np.abs(v) ** alpha * upper).sum(axis=1)
        return np.where(np.isnan(v[:, -1]), np.nan, worth)

    return _by_code(df, [order], [x], compute, out)


def first_passage(df: DataFrame, x: str, out: str, barrier: float, horizon: int, cohorts: int, day: str = "day") -> DataFrame:
    """Mean sessions until x first rises by ``barrier``, cut at ``horizon``, over the last ``cohorts`` starts that are over.

    A start is over when ``horizon`` sessions follow it; NULL where one of the sessions looked at has no value.
    """

    def compute(values: np.ndarray) -> np.ndarray:
        ahead = np.stack([np.concatenate([values[k:], np.full(min(k, len(values)), np.nan)])[: len(values)] - values for k in range(1, horizon + 1)])
        passed = ahead >= barrier
        times = np.where(passed.any(axis=0), passed.argmax(axis=0) + 1, horizon).astype(float)
        span = cohorts + horizon
        complete = ~np.isnan(_windows(values, span)).any(axis=1)
        result = np.full(len(values), np.nan)
        rows = np.flatnonzero(complete)
        sums = np.concatenate([[0.0], np.cumsum(times)])
        result[rows] = (sums[rows - horizon + 1] - sums[rows - span + 1]) / cohorts
        return result

    return _by_code(df, [day], [x], compute, out)
