"""Price layer of a dense panel: adjusted prices, clean returns, turnover, labels and tradability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cross import pct_rank
from ..functions.scalar import safe_div
from ..functions.windows import Series

S = Series()


def adjusted(price: Column, factor: Column) -> Column:
    """Price and factor, each carried forward, multiplied: what was known on the day, adjusted backward."""
    return S.ffill(price) * S.ffill(factor)


def daily_return(adjusted_close: Column, bound: float = 0.6) -> Column:
    """Change of the adjusted price; NULL where it is over ``bound`` in size."""
    r = safe_div(adjusted_close, S.shift(adjusted_close)) - 1
    return F.when(F.abs(r) <= bound, r)


def period_return(daily: Column, traded: Column, k: int) -> Column:
    """Compounded return of k sessions; NULL unless all are there and one of them was traded."""
    w = S.last(k)
    return S.full(F.when(F.count_if(F.coalesce(traded, F.lit(False))).over(w) > 0, F.expm1(F.sum(F.log1p(daily)).over(w))), daily, k)


def clean_return(daily: Column, traded: Column, k: int = 1) -> Column:
    """Return over k sessions that were all traded."""
    own = F.when(traded, daily)
    return own if k == 1 else S.full(F.expm1(F.sum(F.log1p(own)).over(S.last(k))), own, k)


def was_traded(volume: Column) -> Column:
    return F.coalesce(volume > 0, F.lit(False))


def turnover(volume: Column, shares: Column, floor: float = 1.0) -> Column:
    """Volume over the shares last known, in percent."""
    return safe_div(volume, S.ffill(shares), floor) * 100


def forward_return(open_: Column, traded: Column, horizon: int) -> Column:
    """Label: from the next session's open to the open ``horizon`` sessions on, both traded."""
    both = S.shift(traded.cast("int"), -1) + S.shift(traded.cast("int"), -(horizon + 1)) == 2
    return F.when(both, safe_div(S.shift(open_, -(horizon + 1)), S.shift(open_, -1)) - 1)


def covered_window(covered: Column, n: int, least: float) -> Column:
    """Whether each of the last n sessions has a coverage of ``least``."""
    return F.coalesce(F.when(S.row() >= n, F.min(covered).over(S.last(n)) >= least), F.lit(False))


def hot_pool(df: DataFrame, parts: dict[str, Column], n: int, share: float, out: str = "hot") -> DataFrame:
    """Rows in the day's best ``share`` by the mean rank of several activities, each averaged over n sessions."""
    means = df.withColumns({f"__m_{k}": S.mean(c, n, 1) for k, c in parts.items()})
    ranks = means.withColumns({f"__r_{k}": pct_rank(F.col(f"__m_{k}")) for k in parts})
    score = sum((F.col(f"__r_{k}") for k in parts), F.lit(0.0)) / len(parts)
    scored = ranks.withColumn("__s", F.round(score, 9))  # equal means are ties, however they were summed
    return scored.withColumn(out, F.coalesce(pct_rank(F.col("__s")) > 1 - share, F.lit(False))).drop("__s", *[f"__{p}_{k}" for k in parts for p in "mr"])


def announced_window(grid: DataFrame, events: DataFrame, days: DataFrame, before: int) -> DataFrame:
    """Grid rows from ``before`` sessions before each of the code's events up to its day.

    Event days become session numbers, and each event is spread over its few sessions: an equi-join.
    """
    from .grid import calendar

    numbered = calendar(days).select("day", "session")
    spread = events.select("code", "day").distinct().join(numbered, "day").select("code", F.explode(F.sequence(F.col("session") - before, F.col("session"))).alias("session"))
    inside = spread.distinct().join(numbered, "session").select("code", "day", F.lit(True).alias("announced"))
    return grid.join(inside, ["code", "day"], "left").withColumn("announced", F.coalesce("announced", F.lit(False)))
