"""Report values with two times: the period they describe and the day they were known.

A vintage is a row (code, period, pit, values): period is a quarter ordinal, pit the day of knowledge.
All restatements are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["code", "period", "pit"]


def known_on(*days: Column) -> Column:
    """Day of knowledge: the latest of the announcement days that are there."""
    return F.greatest(*days) if len(days) > 1 else days[0]


def merge_sources(parts: list[DataFrame]) -> DataFrame:
    """Full outer join of vintage tables with different values on (code, period, pit)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, KEYS, "full")
    return out


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row of each key that comes last in ``order``, which must be total: nothing arbitrary is kept."""
    w = Window.partitionBy(*keys).orderBy(*[o.desc_nulls_last() for o in order])
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def frontier(vintages: DataFrame) -> DataFrame:
    """For each (code, pit) the newest period known by then and that period's row.

    A late correction of an old period does not displace a newer report.
    """
    w = Window.partitionBy("code").orderBy("pit", "period").rowsBetween(Window.unboundedPreceding, 0)
    current = vintages.withColumn("__front", F.max("period").over(w)).where(F.col("period") == F.col("__front")).drop("__front")
    return latest(current, ["code", "pit"], [F.col("period")])


def revision_events(vintages: DataFrame) -> DataFrame:
    """(code, pit, period): at each day of knowledge, the newest period by then.

    A correction of an old period is an event for the current report, too.
    """
    w = Window.partitionBy("code").orderBy("pit", "period").rowsBetween(Window.unboundedPreceding, 0)
    return vintages.select("code", "pit", F.max("period").over(w).alias("period")).groupBy("code", "pit").agg(F.max("period").alias("period"))


def at_period(events: DataFrame, vintages: DataFrame, value: str, out: str, lag: int = 0) -> DataFrame:
    """``events`` (code, period, pit, …) with the value of the period ``lag`` quarters before, as known at pit.

    Vintages and events of a (code, period) are merged by day of knowledge and the last value is
    carried on, so a restated old period is seen only from its own day.
    """
    kept = [c for c in events.columns if c not in KEYS]
    v = vintages.select("code", F.col("period").alias("__p"), "pit", F.lit(0).alias("__g"), F.struct(F.col(value).alias("v")).alias("__v"), *[F.lit(None).cast(events.schema[c].dataType).alias(c) for c in kept], F.lit(None).cast(events.schema["period"].dataType).alias("period"))
    e = events.select("code", (F.col("period") - lag).alias("__p"), "pit", F.lit(1).alias("__g"), F.lit(None).cast(v.schema["__v"].dataType).alias("__v"), *kept, "period")
    w = Window.partitionBy("code", "__p").orderBy("pit", "__g").rowsBetween(Window.unboundedPreceding, 0)
    merged = v.unionByName(e).withColumn("__seen", F.last("__v", ignorenulls=True).over(w)).where("__g = 1")
    return merged.select(*KEYS, *kept, F.col("__seen.v").alias(out))


def at_periods(events: DataFrame, vintages: DataFrame, value: str, lags: list[int], prefix: str) -> DataFrame:
    """``events`` with the values of several periods before, ``prefix`` + lag, each as known at pit.

    Each vintage is told to the periods that it serves, so all lags come out of one sort: one shuffle of
    as many vintage rows as there are lags, instead of a shuffle for each lag.
    """
    kept = [c for c in events.columns if c not in KEYS]
    told = vintages.select("code", F.explode(F.array(*[F.struct((F.col("period") + k).alias("period"), F.lit(k).alias("__k")) for k in lags])).alias("__t"), "pit", F.struct(F.col(value).alias("v")).alias("__v"))
    told = told.select("code", "__t.period", "pit", F.lit(0).alias("__g"), "__t.__k", "__v", *[F.lit(None).cast(events.schema[c].dataType).alias(c) for c in kept])
    asked = events.select("code", "period", "pit", F.lit(1).alias("__g"), F.lit(None).cast("int").alias("__k"), F.lit(None).cast(told.schema["__v"].dataType).alias("__v"), *kept)
    w = Window.partitionBy("code", "period").orderBy("pit", "__g").rowsBetween(Window.unboundedPreceding, 0)
    seen = {f"__s{k}": F.last(F.when(F.col("__k") == k, F.col("__v")), ignorenulls=True).over(w) for k in lags}
    return told.unionByName(asked).withColumns(seen).where("__g = 1").select(*KEYS, *kept, *[F.col(f"__s{k}.v").alias(f"{prefix}{k}") for k in lags])


def trailing_year(events: DataFrame, vintages: DataFrame, value: str, out: str, strict: bool = False) -> DataFrame:
    """Sum of the last four quarters of a figure that is cumulative over its year.

    The year's figure so far, plus last year's total, less last year's figure at the same quarter; the
    fourth quarter stands for itself. Unless ``strict``, the sum of four single quarters fills in
    where one of the three is missing.
    """
    quarter = F.pmod(F.col("period"), F.lit(4))
    work = at_periods(events, vintages, value, list(range(5 if strict else 8)), "__c")
    cum = [F.col(f"__c{k}") for k in range(5 if strict else 8)]
    back = lambda k: F.element_at(F.array(*cum), F.lit(1) + k)
    three = F.when(quarter == 3, cum[0]).otherwise(cum[0] + back((quarter + 1).cast("int")) - cum[4])
    if not strict:
        single = [F.when(F.pmod(F.col("period") - k, F.lit(4)) == 0, cum[k]).otherwise(cum[k] - cum[k + 1]) for k in range(4)]
        three = F.coalesce(three, sum(single[1:], single[0]))
    return work.withColumn(out, three).drop(*[c for c in work.columns if c.startswith("__c")])


def single_quarter(events: DataFrame, vintages: DataFrame, value: str, out: str) -> DataFrame:
    """The quarter's own figure from a cumulative one."""
    work = at_periods(events, vintages, value, [0, 1], "__c")
    own = F.when(F.pmod(F.col("period"), F.lit(4)) == 0, F.col("__c0")).otherwise(F.col("__c0") - F.col("__c1"))
    return work.withColumn(out, own).drop("__c0", "__c1")


def first_vintage(vintages: DataFrame) -> DataFrame:
    """The first known row of each period."""
    w = Window.partitionBy("code", "period").orderBy("pit")
    return vintages.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def two_newest_periods(vintages: DataFrame, value: str) -> DataFrame:
    """At each (code, pit): the newest period known and the one before it among those known, with the
    newest version of each.

    The running set of a code's periods holds its quarters, not its rows; the values come from the
    vintages of the two periods.
    """
    w = Window.partitionBy("code").orderBy("pit", "period").rowsBetween(Window.unboundedPreceding, 0)
    known = latest(vintages.select("code", "pit", "period", F.collect_set("period").over(w).alias("__k")), ["code", "pit"], [F.col("period")])
    two = known.select("code", "pit", F.sort_array("__k", asc=False).alias("__k")).select("code", "pit", F.get("__k", 0).alias("newest"), F.get("__k", 1).alias("previous"))
    first = at_period(two.withColumn("period", F.col("newest")), vintages, value, "value")
    return at_period(first.withColumn("period", F.col("previous")), vintages, value, "previous_value").select("code", "pit", "newest", "previous", "value", "previous_value")


def surprise(quarters: DataFrame, value: str, out: str, n: int = 8, least: int = 6) -> DataFrame:
    """Standardised seasonal difference: this quarter less the same quarter a year ago, over the standard
    deviation of the last ``n`` such differences before it."""
    w = Window.partitionBy("code").orderBy("period")
    diff = F.when(F.lag("period", 4).over(w) == F.col("period") - 4, F.col(value) - F.lag(value, 4).over(w))
    work = quarters.withColumn("__d", diff)
    past = w.rowsBetween(-n, -1)
    spread = F.when(F.count("__d").over(past) >= least, F.stddev_samp("__d").over(past))
    return work.withColumn(out, F.when(spread > 1e-12, F.col("__d") / spread)).drop("__d")


#: Kinds of report fields: points in time, sums over the year so far, and ratios of such sums.
POINT, CUMULATIVE, RATIO = "point", "cumulative", "ratio"


def require_kind(fields: dict[str, str], field: str, use: str) -> str:
    """``field``, where its declared kind allows the use; a ratio over part of a year allows none but "as_is".

    Trailing sums and single quarters need cumulative fields, balances are points.
    """
    allowed = {"trailing": (CUMULATIVE,), "quarter": (CUMULATIVE,), "point": (POINT, CUMULATIVE), "as_is": (POINT, CUMULATIVE, RATIO)}
    if field not in fields:
        raise ValueError(f"{field} is not declared")
    if fields[field] not in allowed[use]:
        raise ValueError(f"{field} is a {fields[field]} field and cannot be used as {use}")
    return field


def lagged_trailing_year(events: DataFrame, vintages: DataFrame, value: str, out: str, lag: int) -> DataFrame:
    """Trailing year of the period ``lag`` quarters before, as known at each event's own day."""
    moved = trailing_year(events.withColumn("period", F.col("period") - lag), vintages, value, out)
    return moved.withColumn("period", F.col("period") + lag)
