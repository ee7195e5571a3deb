"""Set operations, deduplication, interval sets, reconciliation and logical fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each key, the last by ``order`` (descending there); never an arbitrary one."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Rows of all parts; columns that a part lacks are NULL there."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def same_content(a: DataFrame, b: DataFrame) -> bool:
    """Whether both hold the same rows, each as often."""
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def merge_intervals(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Union of closed day intervals (from_day, to_day): overlapping and adjacent ones become one."""
    w = Window.partitionBy(*keys).orderBy("from_day", "to_day")
    reach = F.max("to_day").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(reach.isNull() | (F.col("from_day") > F.date_add(reach, 1)), 1).otherwise(0)
    grouped = spans.where("from_day <= to_day").withColumn("__new", new).withColumn("__g", F.sum("__new").over(w))
    return grouped.groupBy(*keys, "__g").agg(F.min("from_day").alias("from_day"), F.max("to_day").alias("to_day")).drop("__g")


def missing_intervals(spans: DataFrame, keys: list[str], begin: str, end: str) -> DataFrame:
    """What the intervals leave open between the days ``begin`` and ``end``."""
    merged = merge_intervals(spans, keys).where((F.col("to_day") >= F.lit(begin).cast("date")) & (F.col("from_day") <= F.lit(end).cast("date")))
    w = Window.partitionBy(*keys).orderBy("from_day")
    first, last = F.lit(begin).cast("date"), F.lit(end).cast("date")
    before = merged.select(*keys, F.coalesce(F.date_add(F.lag("to_day").over(w), 1), first).alias("gap_from"), F.date_sub("from_day", 1).alias("gap_to"))
    after = merged.groupBy(*keys).agg(F.date_add(F.max("to_day"), 1).alias("gap_from")).withColumn("gap_to", last)
    return before.unionByName(after).where("gap_from <= gap_to").select(*keys, F.greatest("gap_from", first).alias("gap_from"), F.least("gap_to", last).alias("gap_to"))


def reconcile(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on which two tables differ: ``only_left``, ``only_right`` or ``changed``."""
    values = [c for c in a.columns if c not in keys]
    left = a.select(*keys, F.struct(*values).alias("__l"))
    right = b.select(*keys, F.struct(*values).alias("__r"))
    joined = left.join(right, keys, "full")
    kind = F.when(F.col("__r").isNull(), "only_left").when(F.col("__l").isNull(), "only_right").when(~F.col("__l").eqNullSafe(F.col("__r")), "changed")
    return joined.select(*keys, kind.alias("difference")).where("difference is not null")


def fingerprint(df: DataFrame, by: list[str]) -> DataFrame:
    """Count and order-insensitive hash of each group's rows; equal rows count as often as they occur."""
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in sorted(df.columns)]
    h = F.conv(F.substring(F.md5(F.concat_ws("\x1f", *columns)), 1, 12), 16, 10).cast("decimal(38,0)")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(h).alias("hash_sum"))


def compare_fingerprints(old: DataFrame, new: DataFrame, by: list[str]) -> DataFrame:
    """Groups that are new, gone or rewritten between two ledgers."""
    o = old.select(*by, F.struct("n_rows", "hash_sum").alias("__o"))
    n = new.select(*by, F.struct("n_rows", "hash_sum").alias("__n"))
    kind = F.when(F.col("__o").isNull(), "new").when(F.col("__n").isNull(), "gone").when(F.col("__o") != F.col("__n"), "rewritten")
    return o.join(n, by, "full").select(*by, kind.alias("change")).where("change is not null")


def collapse_periods(df: DataFrame, unit: str, keys: list[str], day: str = "day") -> DataFrame:
    """Last row of each key in each week (from Monday) or month."""
    period = F.trunc(day, unit) if unit != "week" else F.date_trunc("week", day).cast("date")
    w = Window.partitionBy(*keys, "period").orderBy(F.col(day).desc())
    return df.withColumn("period", period).withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
