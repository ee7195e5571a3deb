"""Evaluation, splits, portfolios and ledgers over (day, code, score, …) tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cross import pct_rank
from ..functions.scalar import fin, trade_fee


def correlation(a: str, b: str) -> Column:
    """Aggregate correlation over the complete pairs; NULL where a side does not vary."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = F.when(both, F.col(a)), F.when(both, F.col(b))
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return fin(F.when(spread > 1e-18, F.try_divide(F.covar_pop(x, y), spread)))


def daily_ic(df: DataFrame, score: str, ret: str) -> DataFrame:
    """Correlation and rank correlation of score and return on each day."""
    both = df.where(F.col(score).isNotNull() & F.col(ret).isNotNull())
    ranked = both.select("day", score, ret, pct_rank(F.col(score)).alias("__s"), pct_rank(F.col(ret)).alias("__r"))
    return ranked.groupBy("day").agg(F.count(F.lit(1)).alias("n"), correlation(score, ret).alias("ic"), correlation("__s", "__r").alias("rank_ic"))


def ic_table(ics: DataFrame, period: Column) -> DataFrame:
    """Mean, deviation and ratio of both correlations for each period, and for all periods (NULL)."""
    cut = ics.withColumn("period", period).rollup("period").agg(F.count("ic").alias("n_days"), F.avg("ic").alias("ic"), F.stddev_samp("ic").alias("__s"), F.avg("rank_ic").alias("rank_ic"), F.stddev_samp("rank_ic").alias("__r"))
    return cut.select("period", "n_days", "ic", "rank_ic", F.when(F.col("__s") > 1e-12, F.col("ic") / F.col("__s")).alias("icir"), F.when(F.col("__r") > 1e-12, F.col("rank_ic") / F.col("__r")).alias("rank_icir"))


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean over days of each pair's correlation: one pass, one aggregate for all pairs of columns."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    daily = df.groupBy("day").agg(*[correlation(a, b).alias(f"{a}|{b}") for a, b in pairs])
    means = daily.agg(*[F.avg(F.col(f"`{a}|{b}`")).alias(f"{a}|{b}") for a, b in pairs])
    return means.unpivot([], [f"`{a}|{b}`" for a, b in pairs], "pair", "corr").select(F.split("pair", r"\|")[0].alias("a"), F.split("pair", r"\|")[1].alias("b"), "corr")


def ridge(df: DataFrame, y: str, xs: list[str], penalty: float) -> list[float]:
    """Ridge coefficients (intercept first, not penalised) from the summed normal equations."""
    import numpy as np

    full = df.dropna(subset=[y, *xs])
    names = ["1", *xs]
    col = lambda c: F.lit(1.0) if c == "1" else F.col(c).cast("double")
    sums = full.agg(*[F.sum(col(a) * col(b)).alias(f"s{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names) if j >= i], *[F.sum(col(a) * F.col(y)).alias(f"y{i}") for i, a in enumerate(names)]).first()
    k = len(names)
    a = np.array([[sums[f"s{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)])
    a += np.diag([0.0] + [penalty] * (k - 1))
    return np.linalg.lstsq(a, np.array([sums[f"y{i}"] or 0.0 for i in range(k)]), rcond=None)[0].tolist()


def rank_order(df: DataFrame, score: str) -> DataFrame:
    """Place of each row of a day by score, best first; ties by code; rows without a score have none."""
    w = Window.partitionBy("day").orderBy(F.col(score).desc_nulls_last(), "code")
    return df.withColumn("place", F.when(F.col(score).isNotNull(), F.row_number().over(w)))


def top_rows(df: DataFrame, score: str, k: int) -> DataFrame:
    w = Window.partitionBy("day").orderBy(F.col(score).desc_nulls_last(), "code")
    return df.where(F.col(score).isNotNull()).withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def capacity_portfolio(df: DataFrame, score: str, liquidity: str, ret: str, money: float, n: int | None = None) -> DataFrame:
    """Each day's return when money fills the ranking from the top, each name up to its liquidity.

    The walk ends where the money does; ``n`` ends it earlier, after so many names.
    """
    ranked = rank_order(df.where(F.col(liquidity) > 0), score).where("place is not null") if n is None else top_rows(df.where(F.col(liquidity) > 0), score, n)
    w = Window.partitionBy("day").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(liquidity).over(w), F.lit(0.0))
    held = ranked.withColumn("hold", F.greatest(F.lit(0.0), F.least(F.col(liquidity), money - before)))
    return held.groupBy("day").agg((F.sum(F.col("hold") * F.coalesce(ret, F.lit(0.0))) / money).alias("portfolio_ret"), F.count_if(F.col("hold") > 0).alias("n_held"), (F.sum("hold") / money).alias("filled"))


def realizable_top(df: DataFrame, score: str, ret: str, entry: str, k: int) -> DataFrame:
    """Mean return of the day's top k, of all and of those that can be bought."""
    return top_rows(df, score, k).groupBy("day").agg(F.avg(ret).alias("top_ret"), F.avg(F.when(F.col(entry), F.col(ret))).alias("realizable_ret"), F.avg(F.col(entry).cast("double")).alias("entry_share"))


def head_tail(df: DataFrame, score: str, ret: str, share: float = 0.1) -> DataFrame:
    """Mean return of the best and the worst ``share`` of each day, and their difference."""
    ranked = df.where(F.col(score).isNotNull() & F.col(ret).isNotNull()).select("day", ret, pct_rank(F.col(score)).alias("__r"))
    head, tail = F.avg(F.when(F.col("__r") > 1 - share, F.col(ret))), F.avg(F.when(F.col("__r") <= share, F.col(ret)))
    return ranked.groupBy("day").agg(head.alias("head_ret"), tail.alias("tail_ret"), (head - tail).alias("spread"))


def sign_adjusted(df: DataFrame, ic: str, head: str, tail: str, out: str) -> DataFrame:
    return df.withColumn(out, F.when(F.col(ic) < 0, F.col(tail)).otherwise(F.col(head)))


def capped_by_amount(df: DataFrame, score: str, amount: str, ret: str, cap: float) -> DataFrame:
    """Mean return of the day's best names while their amounts add up to ``cap`` at most."""
    ranked = rank_order(df, score).where("place is not null")
    w = Window.partitionBy("day").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    return ranked.withColumn("__c", F.sum(amount).over(w)).where(F.col("__c") <= cap).groupBy("day").agg(F.avg(ret).alias("capped_ret"), F.count(F.lit(1)).alias("n_names"))


def wpcc(df: DataFrame, score: str, ret: str, decay: float = 0.5) -> DataFrame:
    """Correlation with weights that fall with the rank of the return, best first."""
    both = df.where(F.col(score).isNotNull() & F.col(ret).isNotNull())
    w = Window.partitionBy("day").orderBy(F.col(ret).desc(), "code")
    n = F.count(F.lit(1)).over(Window.partitionBy("day"))
    weighted = both.withColumn("__w", F.when(n > 1, F.pow(F.lit(decay), (F.row_number().over(w) - 1) / (n - 1))).otherwise(1.0))
    a, b, k = F.col(score), F.col(ret), F.col("__w")
    total = F.sum(k)
    ma, mb = F.sum(k * a) / total, F.sum(k * b) / total
    cov = F.sum(k * a * b) / total - ma * mb
    va, vb = F.sum(k * a * a) / total - ma * ma, F.sum(k * b * b) / total - mb * mb
    return weighted.groupBy("day").agg(fin(F.when((va > 1e-18) & (vb > 1e-18), cov / F.sqrt(va * vb))).alias("wpcc"))


def drawdown(df: DataFrame, ret: str, keys: list[str]) -> DataFrame:
    """Compounded value and its fall from the highest value so far."""
    w = Window.partitionBy(*keys).orderBy("day").rowsBetween(Window.unboundedPreceding, 0) if keys else Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    value = df.withColumn("value", F.exp(F.sum(F.log1p(F.coalesce(ret, F.lit(0.0)))).over(w)))
    return value.withColumn("drawdown", F.col("value") / F.greatest(F.lit(1.0), F.max("value").over(w)) - 1)


def summary(df: DataFrame, ret: str, keys: list[str], year: int = 242) -> DataFrame:
    """Compounded return, Sharpe ratio and largest drawdown."""
    path = drawdown(df, ret, keys)
    return path.groupBy(*keys).agg(F.count(ret).alias("n_days"), (F.exp(F.sum(F.log1p(F.coalesce(ret, F.lit(0.0))))) - 1).alias("total_ret"), F.when(F.stddev_samp(ret) > 1e-12, F.avg(ret) / F.stddev_samp(ret) * year**0.5).alias("sharpe"), F.min("drawdown").alias("max_drawdown"))


def walk_forward(days: DataFrame, folds: int, train: int, purge: int, test: int) -> DataFrame:
    """(fold, part, day): test windows one after another at the end, each after ``train`` days and a purged gap."""
    from .grid import calendar

    numbered = calendar(days).select("day", "session")
    total = numbered.agg(F.max("session").alias("__n"))
    fold = numbered.join(F.broadcast(total)).withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds))))
    begin = F.col("__n") - (folds - F.col("fold") + 1) * test + 1
    part = F.when(F.col("session").between(begin, begin + test - 1), "test").when(F.col("session").between(begin - purge - train, begin - purge - 1), "train")
    return fold.withColumn("part", part).where("part is not null").select("fold", "part", "day")


def covered(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """Share of rows with a value, for each column."""
    cut = df.groupBy(*keys).agg(*[F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in columns])
    return cut.unpivot(keys, columns, "name", "coverage")


def verify_labels(df: DataFrame, label: str, expected: Column, tolerance: float = 1e-5) -> DataFrame:
    """How many labels are checked and how many lie off by more than ``tolerance``."""
    off = F.abs(F.col(label) - expected) > tolerance
    return df.where(F.col(label).isNotNull() & expected.isNotNull()).agg(F.count(F.lit(1)).alias("n_checked"), F.count_if(off).alias("n_off"))


def extreme_strength(columns: list[str], over: float = 2.0) -> Column:
    """Sum over columns of what each exceeds ``over``."""
    return sum((F.greatest(F.coalesce(F.col(c), F.lit(0.0)) - over, F.lit(0.0)) for c in columns), F.lit(0.0))


def with_fees(df: DataFrame, amount: str, selling: str) -> DataFrame:
    return df.withColumn("fee", trade_fee(amount, F.col(selling)))


def cash_ledger(ranked: DataFrame, cash: float = 1_000_000.0, hold: int = 10, band: int = 20, lot: int = 100) -> DataFrame:
    """Sequential ledger for each strategy: (strategy, day, cash, value, n_held, turnover).

    ``ranked`` has (strategy, day, code, place, price, can_buy, can_sell) for the top of each day's
    ranking only, so a strategy's rows are bounded by days times that top. Names out of the band are
    sold on the next session, then the best names not held are bought in whole lots with what cash
    allows. Each strategy is one group, and strategies run beside each other.
    """

    def fee(amount: float, selling: bool) -> float:
        return max(amount * 0.00025, 5.0) + amount * 1e-5 + (amount * 5e-4 if selling else 0.0)

    def run(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values(["day", "place", "code"])
        money, held, last, out = cash, {}, {}, []
        for day, today in rows.groupby("day", sort=True):
            info = {r.code: r for r in today.itertuples()}
            turnover = 0.0
            for code in sorted(held):
                r = info.get(code)
                if r is not None and r.place > band and r.can_sell and r.price > 0:
                    amount = held.pop(code) * r.price
                    money += amount - fee(amount, True)
                    turnover += amount
            for r in today.itertuples():
                if len(held) >= hold or r.place > hold:
                    break
                if r.code in held or not r.can_buy or not r.price > 0:
                    continue
                lots = int(money / (hold - len(held)) / (r.price * lot))
                while lots > 0 and lots * lot * r.price + fee(lots * lot * r.price, False) > money:
                    lots -= 1
                if lots > 0:
                    amount = lots * lot * r.price
                    money -= amount + fee(amount, False)
                    held[r.code] = lots * lot
                    turnover += amount
            last.update({c: r.price for c, r in info.items() if r.price > 0})
            out.append((key[0], day, money, money + sum(n * last.get(c, 0.0) for c, n in held.items()), len(held), turnover))
        yield pd.DataFrame(out, columns=["strategy", "day", "cash", "value", "n_held", "turnover"])

    return ranked.groupBy("strategy").applyInPandas(run, "strategy string, day date, cash double, value double, n_held long, turnover double")


def ridge_table(df: DataFrame, y: str, xs: list[str], penalty: float) -> DataFrame:
    """(name, coefficient) of ``ridge``, the intercept as ``1``."""
    return df.sparkSession.createDataFrame(list(zip(["1", *xs], ridge(df, y, xs, penalty), strict=True)), "name string, coefficient double")


def merge_scores(a: DataFrame, b: DataFrame, names: tuple[str, str] = ("a", "b"), score: str = "score") -> DataFrame:
    """(day, code) that both have, with both scores."""
    return a.select("day", "code", F.col(score).alias(names[0])).join(b.select("day", "code", F.col(score).alias(names[1])), ["day", "code"])


def blend_ranks(df: DataFrame, heads: dict[str, float], out: str = "score") -> DataFrame:
    """Weighted mean of the heads' percentiles within each day, over the heads that a row has."""
    ranked = df.withColumns({f"__p_{h}": pct_rank(F.col(h)) for h in heads})
    total = sum((F.coalesce(w * F.col(f"__p_{h}"), F.lit(0.0)) for h, w in heads.items()), F.lit(0.0))
    weight = sum((F.when(F.col(f"__p_{h}").isNotNull(), F.lit(float(w))).otherwise(0.0) for h, w in heads.items()), F.lit(0.0))
    return ranked.withColumn(out, F.when(weight > 0, total / weight)).drop(*[f"__p_{h}" for h in heads])


def blend_ridge(df: DataFrame, heads: list[str], ret: str, penalty: float, out: str = "score") -> DataFrame:
    """Heads weighed by a ridge fit of the returns."""
    intercept, *weights = ridge(df, ret, heads, penalty)
    return df.withColumn(out, sum((w * F.col(h) for h, w in zip(heads, weights, strict=True)), F.lit(intercept)))


def fuse_common(df: DataFrame, parts: dict[str, float], out: str = "score") -> DataFrame:
    """Scores standardised over the rows of a day that have all of them, and summed by weight; other rows leave."""
    full = df.where(sum((fin(F.col(p)).isNotNull().cast("int") for p in parts), F.lit(0)) == len(parts))
    w = Window.partitionBy("day")
    z = lambda p: F.when(F.stddev_pop(p).over(w) > 1e-12, (F.col(p) - F.avg(p).over(w)) / F.stddev_pop(p).over(w)).otherwise(0.0)
    return full.withColumn(out, sum((k * z(p) for p, k in parts.items()), F.lit(0.0)))


def payload_hashes(scores: DataFrame, payload: list[str]) -> DataFrame:
    """(day, n_rows, sha256) of the rows' payload, whatever their order: each row is hashed, and the sorted hashes are.

    A day's hashes are as many as entities.
    """
    row = F.sha2(F.concat_ws("|", "code", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in payload]), 256)
    return scores.groupBy("day").agg(F.count(F.lit(1)).alias("n_rows"), F.sha2(F.concat_ws(",", F.sort_array(F.collect_list(row))), 256).alias("sha256"))


def archive_scores(scores: DataFrame, path: str, run: str, payload: list[str]) -> DataFrame:
    """Append a run's scores to an archive with their day's hash; a day that is there with another hash is an error.

    Days that are there already with the same hash are not written again. Returns the hashes of the run.
    """
    spark = scores.sparkSession
    hashes = payload_hashes(scores, payload).withColumn("run", F.lit(run))
    try:
        known = spark.read.parquet(f"{path}/hashes").where(F.col("run") == run).select("day", F.col("sha256").alias("__h"))
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        known = spark.createDataFrame([], "day date, __h string")
    marked = hashes.join(known, "day", "left").persist()
    try:
        if not marked.where("__h <> sha256").isEmpty():
            raise ValueError(f"run {run} is archived with other scores")
        new = marked.where("__h is null").drop("__h")
        scores.join(new.select("day"), "day", "left_semi").withColumn("run", F.lit(run)).write.mode("append").parquet(f"{path}/scores")
        new.write.mode("append").parquet(f"{path}/hashes")
    finally:
        marked.unpersist()
    return hashes


def market_block(daily: DataFrame, columns: list[str], n: int = 252, least: int | None = None) -> DataFrame:
    """Market figures by day, each as it is and as its deviation from its last n days (population deviation)."""
    w = Window.orderBy("day").rowsBetween(-(n - 1), 0)
    k = n if least is None else least
    z = lambda c: F.when((F.count(c).over(w) >= k) & (F.stddev_pop(c).over(w) > 1e-12), (F.col(c) - F.avg(c).over(w)) / F.stddev_pop(c).over(w))
    return daily.select("day", *[F.col(c) for c in columns], *[z(c).alias(f"{c}_z{n}") for c in columns])


def sample_names(names: DataFrame, k: int, seed: int) -> DataFrame:
    """k of the names (a sampling operator): those with the smallest hashes of seed and name, so the draw does not depend on order."""
    return names.select("name").distinct().orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col("name")))).limit(k)
