"""Market scalars: one row for each day out of its cross-section."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cross_section(df: DataFrame, x: str, least: int = 100) -> DataFrame:
    """Mean, deviation, skewness, quartiles and their spread; NULL on days with fewer than ``least`` values."""
    ok = lambda c: F.when(F.count(x) >= least, c)
    q = F.percentile(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    cut = df.groupBy("day").agg(F.count(x).alias("n"), ok(F.avg(x)).alias("mean"), ok(F.stddev_pop(x)).alias("std"), ok(F.skewness(x)).alias("skew"), ok(q).alias("__q"))
    return cut.select("day", "n", "mean", "std", "skew", F.get("__q", 1).alias("median"), (F.get("__q", 2) - F.get("__q", 0)).alias("iqr"))


def share(df: DataFrame, condition: Column, valid: Column, out: str, least: int = 1) -> DataFrame:
    """Share of the valid rows for which the condition holds."""
    ok = F.count_if(valid)
    return df.groupBy("day").agg(F.when(ok >= least, F.count_if(valid & condition) / ok).alias(out))


def sum_if_enough(df: DataFrame, x: str, least: int, out: str) -> DataFrame:
    return df.groupBy("day").agg(F.when(F.count(x) >= least, F.sum(x)).alias(out))


def spread_to_entities(df: DataFrame, market: DataFrame) -> DataFrame:
    """Each row with its day's market figures; a market table has one row a day, so it is small."""
    return df.join(market, "day", "left")


def group_median(df: DataFrame, keys: list[str], x: str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.percentile(x, 0.5).alias(out))


def distinct_count(df: DataFrame, keys: list[str], x: str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_distinct(x).alias(out))


def concentration(df: DataFrame, keys: list[str], name: str, x: str) -> DataFrame:
    """Herfindahl index of the names' shares."""
    by_name = df.groupBy(*keys, name).agg(F.sum(x).alias("__x"))
    total = F.sum("__x").over(Window.partitionBy(*keys))
    return by_name.withColumn("__p", F.when(total > 0, F.col("__x") / total)).groupBy(*keys).agg(F.sum(F.col("__p") * F.col("__p")).alias("hhi"), F.count(F.lit(1)).alias("n_names"))


def mirrored_once(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Rows that a source lists twice, once from each side, kept once: of equal (keys, x, y) one stays."""
    return df.select(*keys, x, y).distinct()


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def mode(df: DataFrame, keys: list[str], x: str) -> DataFrame:
    """Most frequent value; of equally frequent ones the smallest."""
    w = Window.partitionBy(*keys).orderBy(F.col("__n").desc(), x)
    return df.where(F.col(x).isNotNull()).groupBy(*keys, x).agg(F.count(F.lit(1)).alias("__n")).withColumn("__k", F.row_number().over(w)).where("__k = 1").select(*keys, F.col(x).alias("mode"), F.col("__n").alias("n"))


def fields(df: DataFrame, aggregates: dict[str, Column], day: str = "day") -> DataFrame:
    """Many market figures of each day from one scan and one aggregate."""
    return df.groupBy(day).agg(*[c.alias(name) for name, c in aggregates.items()])
