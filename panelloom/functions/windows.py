"""Time-series functions of a dense panel, one row for each (code, day).

Rows of a code stand for consecutive sessions, so a shift by rows is a shift by sessions. By default a
window is poisoned: its result is NULL unless it has all ``n`` rows and no NULL among them. ``least``
relaxes the second condition to that many values; the window must still have its ``n`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from .scalar import fin, safe_div


class Series:
    """Windows over the sessions of each code."""

    def __init__(self, code: str = "code", day: str = "day"):
        self.code, self.day = code, day

    @property
    def all(self) -> WindowSpec:
        return Window.partitionBy(self.code).orderBy(self.day)

    def last(self, n: int) -> WindowSpec:
        return self.all.rowsBetween(-(n - 1), 0)

    def before(self, n: int) -> WindowSpec:
        """The n rows before this one."""
        return self.all.rowsBetween(-n, -1)

    def row(self) -> Column:
        return F.row_number().over(self.all)

    # --- guards ----------------------------------------------------------------------------

    def full(self, value: Column, x: Column, n: int, least: int | None = None) -> Column:
        return F.when((self.row() >= n) & (F.count(x).over(self.last(n)) >= (n if least is None else least)), value)

    # --- shifts and fills ------------------------------------------------------------------

    def shift(self, x: Column, k: int = 1) -> Column:
        """k sessions back; a negative k looks forward and belongs in labels only."""
        return F.lag(x, k).over(self.all) if k >= 0 else F.lead(x, -k).over(self.all)

    def diff(self, x: Column, k: int = 1) -> Column:
        return x - self.shift(x, k)

    def pct_change(self, x: Column, k: int = 1) -> Column:
        """Change over the absolute value k sessions back, which must be over 1e-12."""
        return safe_div(self.diff(x, k), F.abs(self.shift(x, k)), 1e-12)

    def ffill(self, x: Column) -> Column:
        return F.last(x, ignorenulls=True).over(self.all.rowsBetween(Window.unboundedPreceding, 0))

    # --- moving statistics -----------------------------------------------------------------

    def sum(self, x: Column, n: int, least: int | None = None) -> Column:
        return self.full(F.sum(x).over(self.last(n)), x, n, least)

    def mean(self, x: Column, n: int, least: int | None = None) -> Column:
        return self.full(F.avg(x).over(self.last(n)), x, n, least)

    def count(self, x: Column, n: int) -> Column:
        """Values among the last n rows; never poisoned, NULL until there are n rows."""
        return F.when(self.row() >= n, F.count(x).over(self.last(n)))

    def var(self, x: Column, n: int, least: int | None = None, ddof: int = 0) -> Column:
        need = max(n if least is None else least, ddof + 1)
        return self.full((F.var_samp if ddof else F.var_pop)(x).over(self.last(n)), x, n, need)

    def std(self, x: Column, n: int, least: int | None = None, ddof: int = 0) -> Column:
        need = max(n if least is None else least, ddof + 1)
        return self.full((F.stddev_samp if ddof else F.stddev_pop)(x).over(self.last(n)), x, n, need)

    def cov(self, x: Column, y: Column, n: int, least: int | None = None) -> Column:
        both = F.when(x.isNotNull() & y.isNotNull(), x)
        return self.full(F.covar_pop(x, y).over(self.last(n)), both, n, least)

    def corr(self, x: Column, y: Column, n: int, least: int | None = None) -> Column:
        """Pairwise complete; NULL where a side does not vary."""
        both = x.isNotNull() & y.isNotNull()
        a, b = F.when(both, x), F.when(both, y)
        w = self.last(n)
        spread = F.stddev_pop(a).over(w) * F.stddev_pop(b).over(w)
        value = fin(F.when(spread > 0, F.try_divide(F.covar_pop(a, b).over(w), spread)))
        return self.full(F.when(F.abs(value) <= 1 + 1e-9, value), a, n, least)

    def skew(self, x: Column, n: int, least: int | None = None) -> Column:
        """Unbiased skewness of the values in the window (three at least)."""
        k = F.count(x).over(self.last(n))
        g = fin(F.skewness(x).over(self.last(n)))
        return self.full(F.when(k >= 3, g * F.sqrt(k * (k - 1)) / (k - 2)), x, n, least)

    def kurt(self, x: Column, n: int, least: int | None = None) -> Column:
        """Unbiased excess kurtosis of the values in the window (four at least)."""
        k = F.count(x).over(self.last(n))
        g = fin(F.kurtosis(x).over(self.last(n)))
        return self.full(F.when(k >= 4, ((k + 1) * g + 6) * (k - 1) / ((k - 2) * (k - 3))), x, n, least)

    def max(self, x: Column, n: int, least: int | None = None) -> Column:
        return self.full(F.max(x).over(self.last(n)), x, n, least)

    def min(self, x: Column, n: int, least: int | None = None) -> Column:
        return self.full(F.min(x).over(self.last(n)), x, n, least)

    def since_max(self, x: Column, n: int, row: Column) -> Column:
        """Sessions since the window's maximum; of equal ones, since the earliest. ``row`` numbers the sessions."""
        return self.full(row - F.min_by(row, F.struct(-x, row)).over(self.last(n)), x, n)

    def since_min(self, x: Column, n: int, row: Column) -> Column:
        return self.full(row - F.min_by(row, F.struct(x, row)).over(self.last(n)), x, n)

    def rank(self, x: Column, n: int, least: int | None = None) -> Column:
        """Share of the window's other values that lie below the newest."""
        values = F.collect_list(x).over(self.last(n))
        below = F.size(F.filter(values, lambda v: v < x))
        k = F.count(x).over(self.last(n))
        return self.full(F.when(x.isNotNull() & (k >= 2), below / (k - 1)), x, n, least)

    def rank_average(self, x: Column, n: int) -> Column:
        """Rank of the newest value with ties averaged, as a share of the window."""
        values = F.collect_list(x).over(self.last(n))
        below = F.size(F.filter(values, lambda v: v < x))
        equal = F.size(F.filter(values, lambda v: v == x))
        return self.full((below + (equal + 1) / 2) / F.count(x).over(self.last(n)), x, n)

    def quantile(self, x: Column, n: int, q: float, least: int | None = None) -> Column:
        return self.full(F.percentile(x, F.lit(q)).over(self.last(n)), x, n, least)

    def product(self, x: Column, n: int, least: int | None = None) -> Column:
        return self.full(F.product(F.coalesce(x, F.lit(1.0))).over(self.last(n)), x, n, least)

    def ewm(self, x: Column, alpha: float, least: int = 1) -> Column:
        """Recursive exponential mean: a missing value leaves the state as it is.

        It folds the code's history for each row, so it suits histories of some thousand rows;
        ``operators.recursive`` computes the same in one pass.
        """
        history = F.collect_list(F.struct(x.cast("double").alias("v"))).over(self.all.rowsBetween(Window.unboundedPreceding, 0))
        start = F.struct(F.lit(None).cast("double").alias("s"), F.lit(0).alias("n"))
        state = F.aggregate(
            history,
            start,
            lambda a, r: F.when(r["v"].isNull(), a).otherwise(F.struct(F.when(a["s"].isNull(), r["v"]).otherwise(a["s"] + alpha * (r["v"] - a["s"])).alias("s"), (a["n"] + 1).alias("n"))),
        )
        return F.when(state["n"] >= least, state["s"])

    def decay_linear(self, x: Column, n: int) -> Column:
        """Mean with weights n for the newest value down to 1."""
        total = sum(((n - k) * self.shift(x, k) for k in range(n)), F.lit(0.0))
        return self.full(total / (n * (n + 1) / 2), x, n)

    def event_decay(self, event: Column, n: int, half_life: float) -> Column:
        """Sum of the last n sessions' events, each halved every ``half_life`` sessions; missing counts 0."""
        return sum((F.coalesce(self.shift(event, k), F.lit(0.0)) * 0.5 ** (k / half_life) for k in range(n)), F.lit(0.0))

    def since_event(self, event: Column, row: Column) -> Column:
        """Sessions since ``event`` was last true."""
        return row - F.last(F.when(event, row), ignorenulls=True).over(self.all.rowsBetween(Window.unboundedPreceding, 0))

    def observed_mean(self, x: Column, n: int, least: int = 1) -> Column:
        """Mean of the values among the last n rows, which may be fewer at the head."""
        w = self.last(n)
        return F.when(F.count(x).over(w) >= least, F.avg(x).over(w))

    def past_mean(self, x: Column, n: int, least: int | None = None) -> Column:
        """Mean of the n rows before this one."""
        w = self.before(n)
        return F.when(F.count(x).over(w) >= (n if least is None else least), F.avg(x).over(w))

    def past_std(self, x: Column, n: int, least: int | None = None) -> Column:
        w = self.before(n)
        return F.when(F.count(x).over(w) >= (n if least is None else least), F.stddev_pop(x).over(w))

    def zscore(self, x: Column, n: int, least: int | None = None) -> Column:
        w = self.last(n)
        return self.full(safe_div(x - F.avg(x).over(w), F.stddev_pop(x).over(w), 1e-12), x, n, least)

    def slope(self, y: Column, x: Column, n: int, least: int | None = None) -> Column:
        """Slope of y on x over the window."""
        both = y.isNotNull() & x.isNotNull()
        a, b = F.when(both, y), F.when(both, x)
        w = self.last(n)
        return self.full(F.when(F.var_pop(b).over(w) > 1e-18, F.covar_pop(a, b).over(w) / F.var_pop(b).over(w)), a, n, least)

    def residual_std(self, y: Column, x: Column, n: int) -> Column:
        """Standard deviation of y's residuals on x over the window."""
        w = self.last(n)
        vx = F.var_pop(x).over(w)
        left = F.var_pop(y).over(w) - F.pow(F.covar_pop(y, x).over(w), F.lit(2)) / vx
        return self.full(F.when(vx > 1e-18, F.sqrt(F.greatest(left, F.lit(0.0)))), F.when(x.isNotNull(), y), n)

    def slopes2(self, y: Column, x1: Column, x2: Column, n: int) -> tuple[Column, Column]:
        """Slopes of y on two regressors, from the window's moments."""
        w = self.last(n)
        both = x1.isNotNull() & x2.isNotNull() & y.isNotNull()
        a, b, c = F.when(both, y), F.when(both, x1), F.when(both, x2)
        s11, s22, s12 = F.var_pop(b).over(w), F.var_pop(c).over(w), F.covar_pop(b, c).over(w)
        s1y, s2y = F.covar_pop(b, a).over(w), F.covar_pop(c, a).over(w)
        det = s11 * s22 - s12 * s12
        ok = det > 1e-12 * s11 * s22
        return tuple(self.full(F.when(ok, v / det), a, n) for v in (s22 * s1y - s12 * s2y, s11 * s2y - s12 * s1y))

    def autocorr(self, x: Column, lagged: Column, n: int) -> Column:
        return self.corr(x, lagged, n)


def run_length(df, condition: str, out: str, code: str = "code", day: str = "day"):
    """Length of the run of true ``condition`` that ends at each row; 0 where it is not true."""
    w = Window.partitionBy(code).orderBy(day)
    broken = F.when(F.coalesce(F.col(condition), F.lit(False)), 0).otherwise(1)
    split = df.withColumn("__run", F.sum(broken).over(w))
    inside = Window.partitionBy(code, "__run").orderBy(day)
    return split.withColumn(out, F.sum(F.when(F.coalesce(F.col(condition), F.lit(False)), 1).otherwise(0)).over(inside)).drop("__run")
