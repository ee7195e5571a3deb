"""Intraday bars to daily fields: one aggregate for each (code, day), ordered where order matters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def number_bars(bars: DataFrame, order: list[str]) -> DataFrame:
    """Bars with their place in the day from 0 and the close before."""
    w = Window.partitionBy("code", "day").orderBy(*order)
    return bars.withColumn("slot", F.row_number().over(w) - 1).withColumn("previous", F.lag("close").over(w)).withColumn("n_slots", F.count(F.lit(1)).over(Window.partitionBy("code", "day")))


def daily(numbered: DataFrame) -> DataFrame:
    """Open, close, high, low, volume and amount, bar-return moments, counts of rises and standstills."""
    r = F.col("close") / F.col("previous") - 1
    sum_of = lambda x: F.coalesce(F.sum(x), F.lit(0.0))
    return numbered.groupBy("code", "day").agg(
        F.min_by("open", "slot").alias("open"), F.max_by("close", "slot").alias("close"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.sum("vol").alias("vol"), F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n_bars"),
        sum_of(r).alias("sum_r"), sum_of(r * r).alias("sum_r2"), sum_of(F.abs(r)).alias("sum_abs_r"), sum_of(F.when(r > 0, r * r)).alias("sum_up_r2"), sum_of(F.when(r < 0, r * r)).alias("sum_down_r2"),
        F.count_if(r > 0).alias("n_up"), F.count_if(r == 0).alias("n_flat"),
    )


def extreme_places(numbered: DataFrame) -> DataFrame:
    """Where in the day the first highest high and the first lowest low stand, from 0 to 1."""
    scale = F.greatest(F.max("slot"), F.lit(1))
    return numbered.groupBy("code", "day").agg((F.min_by("slot", F.struct(-F.col("high"), F.col("slot"))) / scale).alias("high_place"), (F.min_by("slot", F.struct(F.col("low"), F.col("slot"))) / scale).alias("low_place"))


def path(numbered: DataFrame) -> DataFrame:
    """Largest fall from a high before and largest rise from a low before, within the day."""
    w = Window.partitionBy("code", "day").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    moves = numbered.select("code", "day", (F.col("close") / F.max("close").over(w) - 1).alias("fall"), (F.col("close") / F.min("close").over(w) - 1).alias("rise"))
    return moves.groupBy("code", "day").agg(F.min("fall").alias("max_drawdown"), F.max("rise").alias("max_runup"))


def sessions(bars: DataFrame, morning: Column, afternoon: Column) -> DataFrame:
    """Volume, return and share of volume of the two parts of the day."""
    part = lambda c, name: [F.sum(F.when(c, F.col("vol"))).alias(f"{name}_vol"), (F.max_by(F.when(c, F.col("close")), F.when(c, F.col("slot"))) / F.min_by(F.when(c, F.col("open")), F.when(c, F.col("slot"))) - 1).alias(f"{name}_ret")]
    cut = bars.groupBy("code", "day").agg(*part(morning, "am"), *part(afternoon, "pm"), F.sum("vol").alias("__v"))
    return cut.withColumn("am_share", F.when(F.col("__v") > 0, F.coalesce("am_vol", F.lit(0.0)) / F.col("__v"))).drop("__v")


def normalize_units(df: DataFrame, close: str = "close", amount: str = "amount", vol: str = "vol") -> DataFrame:
    """Volumes counted in lots become shares: where amount / vol is over ten closes, a lot of 100 was counted."""
    lots = F.try_divide(F.col(amount), F.col(vol)) / F.col(close) > 10
    return df.withColumn(vol, F.when(lots, F.col(vol) * 100).otherwise(F.col(vol)))


def complete(bars: DataFrame, clock: str, wanted: list[int]) -> DataFrame:
    """Days whose bars stand exactly on the wanted clock times."""
    seen = bars.groupBy("code", "day").agg(F.count(F.lit(1)).alias("n_bars"), F.sort_array(F.collect_set(clock)).alias("times"))
    return seen.select("code", "day", "n_bars", ((F.col("n_bars") == len(wanted)) & (F.col("times") == F.array(*map(F.lit, sorted(wanted))))).alias("is_complete"))


def edge(numbered: DataFrame, n: int, head: bool) -> DataFrame:
    """Return, volume and volume share of the first or last n bars of the day."""
    inside = F.col("slot") < n if head else F.col("slot") >= F.col("n_slots") - n
    name = "head" if head else "tail"
    cut = numbered.groupBy("code", "day").agg(
        F.sum(F.when(inside, F.col("vol"))).alias(f"{name}_vol"),
        (F.max_by(F.when(inside, F.col("close")), F.when(inside, F.col("slot"))) / F.min_by(F.when(inside, F.col("open")), F.when(inside, F.col("slot"))) - 1).alias(f"{name}_ret"),
        F.sum("vol").alias("__v"),
    )
    return cut.withColumn(f"{name}_share", F.when(F.col("__v") > 0, F.col(f"{name}_vol") / F.col("__v"))).drop("__v")


def top_bars(numbered: DataFrame, k: int) -> DataFrame:
    """Share of volume in the k bars with the largest |return| / sqrt(volume)."""
    r = F.abs(F.col("close") / F.col("previous") - 1)
    scored = numbered.withColumn("__s", F.when(F.col("vol") > 0, r / F.sqrt("vol")))
    w = Window.partitionBy("code", "day").orderBy(F.col("__s").desc_nulls_last(), "slot")
    ranked = scored.withColumn("__n", F.row_number().over(w))
    cut = ranked.groupBy("code", "day").agg(F.sum(F.when((F.col("__n") <= k) & F.col("__s").isNotNull(), F.col("vol"))).alias("__t"), F.sum("vol").alias("__v"))
    return cut.select("code", "day", F.when(F.col("__v") > 0, F.coalesce("__t", F.lit(0.0)) / F.col("__v")).alias("top_share"))


def slot_arrays(numbered: DataFrame) -> DataFrame:
    """The day's bar returns and amount shares as arrays in slot order (a day has a bounded number of bars)."""
    r = F.col("close") / F.col("previous") - 1
    lists = numbered.groupBy("code", "day").agg(F.sort_array(F.collect_list(F.struct("slot", r.alias("r"), "amount"))).alias("__b"), F.sum("amount").alias("__a"))
    return lists.select("code", "day", F.transform("__b", lambda b: b["r"]).alias("ret"), F.transform("__b", lambda b: F.when(F.col("__a") > 0, b["amount"] / F.col("__a"))).alias("amount_share"))


def intraday_layer(numbered: DataFrame, morning: Column, k_edge: int = 3, k_top: int = 3) -> DataFrame:
    """All daily fields of the bars as one table, from one sort and one aggregate for each (code, day).

    The running highs and lows, the bars' place by size of move and all sums share the exchange by (code, day).
    """
    day = Window.partitionBy("code", "day")
    so_far = day.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    r = F.col("close") / F.col("previous") - 1
    size = F.when(F.col("vol") > 0, F.abs(r) / F.sqrt("vol"))
    rows = numbered.withColumns({"__r": r, "__fall": F.col("close") / F.max("close").over(so_far) - 1, "__rise": F.col("close") / F.min("close").over(so_far) - 1, "__s": size, "__am": morning})
    rows = rows.withColumn("__top", F.row_number().over(day.orderBy(F.col("__s").desc_nulls_last(), "slot")))
    sum_of = lambda c, x: F.coalesce(F.sum(F.when(c, x)), F.lit(0.0))
    r, am, always = F.col("__r"), F.col("__am"), F.lit(True)
    head, tail = F.col("slot") < k_edge, F.col("slot") >= F.col("n_slots") - k_edge
    ret = lambda c: F.max_by(F.when(c, F.col("close")), F.when(c, F.col("slot"))) / F.min_by(F.when(c, F.col("open")), F.when(c, F.col("slot"))) - 1
    share = lambda c: F.when(F.sum("vol") > 0, F.coalesce(F.sum(F.when(c, F.col("vol"))), F.lit(0)) / F.sum("vol"))
    scale = F.greatest(F.max("slot"), F.lit(1))
    vol = F.col("vol").cast("double")
    return rows.groupBy("code", "day").agg(
        F.min_by("open", "slot").alias("open"), F.max_by("close", "slot").alias("close"), F.max("high").alias("high"), F.min("low").alias("low"), F.sum("vol").alias("vol"), F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n_bars"),
        sum_of(always, r).alias("sum_r"), sum_of(always, r * r).alias("sum_r2"), sum_of(always, F.abs(r)).alias("sum_abs_r"), sum_of(always, r * r * r).alias("sum_r3"), sum_of(r > 0, r * r).alias("sum_up_r2"), sum_of(r < 0, r * r).alias("sum_down_r2"),
        F.count_if(r > 0).alias("n_up"), F.count_if(r == 0).alias("n_flat"), sum_of(always, vol * vol).alias("sum_vol2"), sum_of(r > 0, F.col("vol")).alias("up_vol"),
        (F.min_by("slot", F.struct(-F.col("high"), F.col("slot"))) / scale).alias("high_place"), (F.min_by("slot", F.struct(F.col("low"), F.col("slot"))) / scale).alias("low_place"),
        F.min("__fall").alias("max_drawdown"), F.max("__rise").alias("max_runup"),
        F.sum(F.when(am, F.col("vol"))).alias("am_vol"), ret(am).alias("am_ret"), F.sum(F.when(~am, F.col("vol"))).alias("pm_vol"), ret(~am).alias("pm_ret"), share(am).alias("am_share"),
        ret(head).alias("head_ret"), share(head).alias("head_share"), ret(tail).alias("tail_ret"), share(tail).alias("tail_share"), share((F.col("__top") <= k_top) & F.col("__s").isNotNull()).alias("top_share"),
    )


def opening(numbered: DataFrame, clock: str) -> DataFrame:
    """Amount of the day's first bar and of the day, number of bars, clock time of the first."""
    return numbered.groupBy("code", "day").agg(F.min_by("amount", "slot").alias("open_amount"), F.sum("amount").alias("day_amount"), F.count(F.lit(1)).alias("n_bars"), F.min_by(clock, "slot").alias("first_time"))


def morning_bars(numbered: DataFrame, clock: str, until: int, wanted: int) -> DataFrame:
    """The morning as one bar for each (code, day), and whether all its ``wanted`` clock times up to ``until`` are there."""
    early = numbered.where(F.col(clock) <= until)
    return early.groupBy("code", "day").agg(
        F.min_by("open", "slot").alias("open"), F.max_by("close", "slot").alias("close"), F.max("high").alias("high"), F.min("low").alias("low"), F.sum("vol").alias("vol"),
        F.count(F.lit(1)).alias("n_bars"), ((F.count_distinct(clock) == wanted) & (F.max(clock) == until)).alias("is_complete"),
    )


def slot_structure(arrays: DataFrame) -> DataFrame:
    """Scalars of the slot arrays: bars, concentration and centre of the amount, share of the largest bar, sum of returns."""
    a = F.col("amount_share")
    add = lambda values: F.aggregate(values, F.lit(0.0), lambda s, v: s + F.coalesce(v, F.lit(0.0)))
    centre = add(F.transform(a, lambda v, i: v * i)) / F.greatest(F.size(a) - 1, F.lit(1))
    return arrays.select("code", "day", F.size(a).alias("n_slots"), add(F.transform(a, lambda v: v * v)).alias("concentration"), centre.alias("centre"), F.array_max(a).alias("largest"), add(F.col("ret")).alias("sum_ret"))
