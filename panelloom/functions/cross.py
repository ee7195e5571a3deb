"""Cross-sectional functions: one row against the rows of its day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scalar import clamp, safe_div, winsor_guarded


def of_day(day: str = "day"):
    return Window.partitionBy(day)


def rank_average(x: Column, day: str = "day") -> Column:
    """Rank of x among its day's values with ties averaged; NULL stays NULL.

    Two sorts give the smallest and the largest rank of a tie; no second partition by value is needed.
    """
    w = Window.partitionBy(day)
    n = F.count(x).over(w)
    low = F.rank().over(w.orderBy(x.asc_nulls_last()))
    high = n - F.rank().over(w.orderBy(x.desc_nulls_last())) + 1
    return F.when(x.isNotNull(), (low + high) / 2)


def pct_rank(x: Column, day: str = "day") -> Column:
    return rank_average(x, day) / F.count(x).over(of_day(day))


def winsor(x: Column, low: float = 0.01, high: float = 0.99, day: str = "day") -> Column:
    q = F.percentile(x, F.array(F.lit(low), F.lit(high))).over(of_day(day))
    return winsor_guarded(x, F.get(q, 0), F.get(q, 1))


def cs_rank(df: DataFrame, x: str, out: str, least: int = 100, day: str = "day") -> DataFrame:
    """Percentile rank after clamping to the 1 and 99 % quantiles; NULL on days with fewer than ``least`` values."""
    clipped = df.withColumn("__clipped", winsor(F.col(x), day=day))
    n = F.count("__clipped").over(of_day(day))
    return clipped.withColumn(out, F.when(n >= least, pct_rank(F.col("__clipped"), day))).drop("__clipped")


def demean(x: Column, day: str = "day") -> Column:
    return x - F.avg(x).over(of_day(day))


def zscore(x: Column, day: str = "day", clip: float | None = None) -> Column:
    z = safe_div(demean(x, day), F.stddev_pop(x).over(of_day(day)), 1e-12)
    return z if clip is None else clamp(z, -clip, clip)


def standardize(df: DataFrame, x: str, out: str, least: int = 100, bound: float = 10.0, flip: bool = False, day: str = "day") -> DataFrame:
    """Clamp to quantiles, then z-score, then clamp to ``bound``; NULL on thin days."""
    clipped = df.withColumn("__clipped", winsor(F.col(x), day=day))
    n = F.count("__clipped").over(of_day(day))
    z = clamp(zscore(F.col("__clipped"), day), -bound, bound)
    return clipped.withColumn(out, F.when(n >= least, -z if flip else z)).drop("__clipped")


def dense_pct_rank(x: Column, day: str = "day") -> Column:
    w = Window.partitionBy(day)
    rank = F.dense_rank().over(w.orderBy(x.asc_nulls_last()))
    back = F.dense_rank().over(w.orderBy(x.desc_nulls_last()))
    return F.when(x.isNotNull(), rank / (rank + back - 1))  # both ranks of a value add up to all values, plus one


def residual(y: Column, x: Column, day: str = "day") -> Column:
    """y less its least-squares line on x, among the day's complete rows."""
    w = of_day(day)
    both = y.isNotNull() & x.isNotNull()
    a, b = F.when(both, y), F.when(both, x)
    slope = safe_div(F.covar_pop(a, b).over(w), F.var_pop(b).over(w), 1e-18)
    return a - F.avg(a).over(w) - slope * (b - F.avg(b).over(w))


def residual2(y: Column, x1: Column, x2: Column, day: str = "day") -> Column:
    """y less its least-squares plane on x1 and x2."""
    w = of_day(day)
    both = y.isNotNull() & x1.isNotNull() & x2.isNotNull()
    a, b, c = F.when(both, y), F.when(both, x1), F.when(both, x2)
    s11, s22, s12 = F.var_pop(b).over(w), F.var_pop(c).over(w), F.covar_pop(b, c).over(w)
    s1y, s2y = F.covar_pop(b, a).over(w), F.covar_pop(c, a).over(w)
    det = s11 * s22 - s12 * s12
    k1, k2 = safe_div(s22 * s1y - s12 * s2y, det, 1e-18), safe_div(s11 * s2y - s12 * s1y, det, 1e-18)
    return a - F.avg(a).over(w) - k1 * (b - F.avg(b).over(w)) - k2 * (c - F.avg(c).over(w))


def mean_of_others(x: Column, day: str = "day") -> Column:
    """Mean of the day's other values."""
    w = of_day(day)
    n = F.count(x).over(w)
    return F.when(x.isNotNull() & (n > 1), (F.sum(x).over(w) - x) / (n - 1))


def median_of_others(df: DataFrame, x: str, out: str, day: str = "day") -> DataFrame:
    """Median of the day's other values, from places in the day's order.

    Leaving out place i of n, the others' middle is found among three neighbours of the whole
    median, so each row needs a few values of its day and not the day's list.
    """
    by_value = Window.partitionBy(day).orderBy(F.col(x).asc_nulls_last())
    placed = df.withColumn("__i", F.when(F.col(x).isNotNull(), F.row_number().over(by_value))).withColumn("__n", F.count(x).over(of_day(day)))
    at = lambda k: F.max(F.when(F.col("__i") == k, F.col(x))).over(of_day(day))
    n = F.col("__n")
    half = F.floor(n / 2)
    placed = placed.withColumn("__a", at(half)).withColumn("__b", at(half + 1)).withColumn("__c", at(half + 2))
    odd = n % 2 == 1
    m = half + 1  # the middle place of an odd day
    i = F.col("__i")
    left_odd = (F.when(i <= half, F.col("__b") + F.col("__c")).when(i == m, F.col("__a") + F.col("__c")).otherwise(F.col("__a") + F.col("__b"))) / 2
    left_even = F.when(i <= half, F.col("__b")).otherwise(F.col("__a"))
    return placed.withColumn(out, F.when(i.isNotNull() & (n > 1), F.when(odd, left_odd).otherwise(left_even))).drop("__i", "__n", "__a", "__b", "__c")


def pool_relative(x: Column, member: Column, day: str = "day") -> Column:
    """x less the mean of the day's pool members."""
    return x - F.avg(F.when(member, x)).over(of_day(day))


def fuse(parts: list[Column], weights: list[float]) -> Column:
    """Weighted sum of scores, NULL unless all are there."""
    return sum((w * p for w, p in zip(weights, parts, strict=True)), F.lit(0.0))
