"""Weighted histograms: (code, day, price, weight) rows to one row of figures for each (code, day)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def normalized(levels: DataFrame) -> DataFrame:
    """Levels with a share of their day's weight; levels of one price are added up first."""
    summed = levels.where("weight > 0 and price > 0").groupBy("code", "day", "price").agg(F.sum("weight").alias("weight"))
    return summed.withColumn("w", F.col("weight") / F.sum("weight").over(Window.partitionBy("code", "day")))


def moments(levels: DataFrame) -> DataFrame:
    """Weighted mean, variance, skewness and kurtosis."""
    means = normalized(levels).withColumn("mean", F.sum(F.col("w") * F.col("price")).over(Window.partitionBy("code", "day")))
    d = F.col("price") - F.col("mean")
    cut = means.groupBy("code", "day").agg(F.max("mean").alias("mean"), F.sum(F.col("w") * d * d).alias("var"), F.sum(F.col("w") * d * d * d).alias("m3"), F.sum(F.col("w") * d * d * d * d).alias("m4"), F.count(F.lit(1)).alias("n_levels"))
    some = F.col("var") > 1e-12
    return cut.select("code", "day", "mean", "var", F.when(some, F.col("m3") / F.pow("var", F.lit(1.5))).alias("skew"), F.when(some, F.col("m4") / (F.col("var") * F.col("var"))).alias("kurt"), "n_levels")


def quantiles(levels: DataFrame, qs: list[float]) -> DataFrame:
    """Weighted quantiles by linear interpolation of price over the cumulative share; flat beyond the ends."""
    w = Window.partitionBy("code", "day").orderBy("price")
    cum = normalized(levels).withColumn("cum", F.sum("w").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    steps = cum.withColumn("cum0", F.lag("cum").over(w)).withColumn("price0", F.lag("price").over(w))

    def at(q: float):
        inside = (F.col("cum") >= q) & (F.coalesce("cum0", F.lit(-1.0)) < q)
        line = F.when(F.col("cum0").isNull(), F.col("price")).otherwise(F.col("price0") + (q - F.col("cum0")) / (F.col("cum") - F.col("cum0")) * (F.col("price") - F.col("price0")))
        return F.coalesce(F.min(F.when(inside, line)), F.max("price")).alias(f"q{round(q * 100):02d}")

    return steps.groupBy("code", "day").agg(*map(at, qs))


def concentration(levels: DataFrame, top: int = 3) -> DataFrame:
    """Share of the ``top`` heaviest levels, Herfindahl index, entropy, Gini coefficient and the mode."""
    n = normalized(levels)
    heavy = Window.partitionBy("code", "day").orderBy(F.col("w").desc(), "price")
    light = Window.partitionBy("code", "day").orderBy("w", F.col("price").desc())
    ranked = n.withColumn("__h", F.row_number().over(heavy)).withColumn("__l", F.row_number().over(light)).withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy("code", "day")))
    gini = F.sum((2 * F.col("__l") - F.col("__n") - 1) * F.col("w")) / F.max("__n")
    return ranked.groupBy("code", "day").agg(F.sum(F.when(F.col("__h") <= top, F.col("w"))).alias("top_share"), F.sum(F.col("w") * F.col("w")).alias("hhi"), (-F.sum(F.col("w") * F.log("w"))).alias("entropy"), gini.alias("gini"), F.max(F.when(F.col("__h") == 1, F.col("price"))).alias("mode"))


def peaks(levels: DataFrame) -> DataFrame:
    """Number of levels that are heavier than both neighbours by price."""
    w = Window.partitionBy("code", "day").orderBy("price")
    near = normalized(levels).select("code", "day", "w", F.coalesce(F.lag("w").over(w), F.lit(0.0)).alias("a"), F.coalesce(F.lead("w").over(w), F.lit(0.0)).alias("b"))
    return near.groupBy("code", "day").agg(F.count_if((F.col("w") > F.col("a")) & (F.col("w") > F.col("b"))).alias("n_peaks"))


def around(levels: DataFrame, closes: DataFrame, reach: float = 0.05) -> DataFrame:
    """Shares below and above the day's close, and above it within ``reach``; mean gap and lower half deviation."""
    met = normalized(levels).join(closes, ["code", "day"])
    p, c, w = F.col("price"), F.col("close"), F.col("w")
    z = F.coalesce(F.sum(F.when(p < c, w)), F.lit(0.0)), F.coalesce(F.sum(F.when(p > c, w)), F.lit(0.0)), F.coalesce(F.sum(F.when((p > c) & (p <= c * (1 + reach)), w)), F.lit(0.0))
    return met.groupBy("code", "day").agg(z[0].alias("below"), z[1].alias("above"), z[2].alias("near_above"), F.sum(w * (p / c - 1)).alias("mean_gap"), F.sqrt(F.coalesce(F.sum(F.when(p < c, w * (p / c - 1) * (p / c - 1))), F.lit(0.0))).alias("semi_deviation"))


def tail_mean(levels: DataFrame, share: float = 0.1) -> DataFrame:
    """Weighted mean price of the cheapest ``share`` of the weight; the level at the border counts in part."""
    w = Window.partitionBy("code", "day").orderBy("price").rowsBetween(Window.unboundedPreceding, 0)
    cum = normalized(levels).withColumn("cum", F.sum("w").over(w))
    part = F.greatest(F.lit(0.0), F.least("w", share - (F.col("cum") - F.col("w"))))
    return cum.groupBy("code", "day").agg((F.sum(part * F.col("price")) / F.sum(part)).alias("tail_mean"))


def shortest_half(levels: DataFrame, share: float = 0.5) -> DataFrame:
    """Width of the narrowest price interval that holds ``share`` of the weight.

    A day's levels are a bounded list, so they are folded as one array.
    """
    lists = normalized(levels).groupBy("code", "day").agg(F.sort_array(F.collect_list(F.struct("price", "w"))).alias("l"))
    cum = lists.select("code", "day", "l", F.transform("l", lambda s, i: F.aggregate(F.slice("l", 1, i + 1), F.lit(0.0), lambda a, t: a + t["w"])).alias("c"))
    reach = F.transform("l", lambda s, i: F.array_min(F.transform(F.filter(F.arrays_zip(F.col("l"), F.col("c")), lambda t: t["c"] - (F.get("c", i) - s["w"]) >= share - 1e-12), lambda t: t["l"]["price"])) - s["price"])
    return cum.select("code", "day", F.array_min(F.filter(reach, lambda x: x.isNotNull())).alias("half_width"))


def l_moments(levels: DataFrame) -> DataFrame:
    """First two L-moments of the weighted distribution: mean and half the mean difference of two draws."""
    w = Window.partitionBy("code", "day").orderBy("price").rowsBetween(Window.unboundedPreceding, 0)
    cum = normalized(levels).withColumn("cum", F.sum("w").over(w))
    return cum.groupBy("code", "day").agg(F.sum(F.col("w") * F.col("price")).alias("l1"), F.sum(F.col("w") * F.col("price") * (2 * F.col("cum") - F.col("w") - 1)).alias("l2"))
