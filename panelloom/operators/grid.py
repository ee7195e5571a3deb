"""Dense grids of sessions and entities, and the ways of laying facts on them.

A grid has one row for each session and entity. States are carried forward, flows stay missing, events
count 0 where there are none: ``asof``, ``place`` and ``scatter`` are these three.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def calendar(facts: DataFrame, day: str = "day") -> DataFrame:
    """Sessions in order, numbered from 1, with the session before and after.

    The numbering runs over distinct days, of which there are some thousands however many facts.
    """
    w = Window.orderBy("day")
    days = facts.select(F.col(day).alias("day")).where(F.col(day).isNotNull()).distinct()
    return days.select("day", F.row_number().over(w).alias("session"), F.lag("day").over(w).alias("previous_day"), F.lead("day").over(w).alias("next_day"))


def build(days: DataFrame, entities: DataFrame) -> DataFrame:
    """All (day, code) pairs. Each entity row carries the list of days, so neither side is nested in a loop over the other."""
    listed = days.agg(F.sort_array(F.collect_set("day")).alias("__days"))
    return entities.select("code").distinct().join(F.broadcast(listed)).select("code", F.explode("__days").alias("day"))


def densify(facts: DataFrame) -> DataFrame:
    """Grid over the days and codes of ``facts`` with its values laid on; missing rows are NULL."""
    return place(build(facts.select("day").distinct(), facts.select("code").distinct()), facts)


def place(grid: DataFrame, facts: DataFrame) -> DataFrame:
    """Exact placement: each grid row with the fact of its day and code, NULL without one. Keys must be unique."""
    return grid.join(facts, ["day", "code"], "left")


def check_unique(df: DataFrame, keys: list[str]) -> None:
    """Raise where two rows share their keys."""
    twice = df.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"two rows share {keys}: {twice[0].asDict()}")


def scatter(grid: DataFrame, events: DataFrame, weight: Column | None = None, out: str = "n", covered: bool = False) -> DataFrame:
    """Sum of each day's and code's events, 0 where there are none.

    With ``covered``, days before the first and after the last event of the table are NULL: there the
    table says nothing.
    """
    summed = events.groupBy("day", "code").agg(F.sum(weight if weight is not None else F.lit(1.0)).alias(out))
    laid = grid.join(summed, ["day", "code"], "left").withColumn(out, F.coalesce(out, F.lit(0.0)))
    if not covered:
        return laid
    span = events.agg(F.min("day").alias("__from"), F.max("day").alias("__to"))
    return laid.join(F.broadcast(span)).withColumn(out, F.when(F.col("day").between(F.col("__from"), F.col("__to")), F.col(out))).drop("__from", "__to")


def asof(grid: DataFrame, source: DataFrame, values: list[str], tie: list[str] | None = None, strict: bool = False, max_age: int | None = None) -> DataFrame:
    """Each grid row with the values of its code's newest source row of that day or before.

    Source and grid rows of a code are merged in order and the last source row is carried on: one
    shuffle by code, one sort, no pairs. The values travel in a struct, so a disclosure that is NULL
    clears the state. ``tie`` orders source rows of one day; ``strict`` takes days before only;
    ``max_age`` lets values expire after so many calendar days.
    """
    tie = tie or []
    kept = [c for c in grid.columns if c not in ("day", "code")]
    missing = lambda c: F.lit(None).cast(grid.schema[c].dataType).alias(c)
    tie_types = {c: source.schema[c].dataType for c in tie}
    rows = source.select("code", "day", F.lit(1 if strict else 0).alias("__g"), *[F.col(c).alias(f"__t_{c}") for c in tie], F.struct(F.col("day").alias("day"), *values).alias("__v"), *map(missing, kept))
    value_type = rows.schema["__v"].dataType
    lines = grid.select("code", "day", F.lit(0 if strict else 1).alias("__g"), *[F.lit(None).cast(t).alias(f"__t_{c}") for c, t in tie_types.items()], F.lit(None).cast(value_type).alias("__v"), *kept)
    order = ["day", "__g", *[f"__t_{c}" for c in tie]]
    w = Window.partitionBy("code").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    seen = rows.unionByName(lines).withColumn("__seen", F.last("__v", ignorenulls=True).over(w)).where(F.col("__g") == (0 if strict else 1))
    fresh = F.lit(True) if max_age is None else F.datediff("day", F.col("__seen.day")) <= max_age
    return seen.select("code", "day", *kept, *[F.when(fresh, F.col(f"__seen.{v}")).alias(v) for v in values], F.when(fresh, F.col("__seen.day")).alias("source_day"))


def next_session(source: DataFrame, days: DataFrame, out: str = "next_day", day: str = "day") -> DataFrame:
    """``source`` with the first session strictly after each row's day, NULL after the last."""
    sessions = days.select(F.lit(0).alias("code"), F.col("day").alias("__at"))
    wanted = source.select(F.col(day).alias("__at")).distinct().withColumn("code", F.lit(0))
    both = wanted.withColumn("__w", F.lit(1)).unionByName(sessions.withColumn("__w", F.lit(0)))
    later = Window.partitionBy("code").orderBy("__at", "__w").rowsBetween(1, Window.unboundedFollowing)
    found = both.withColumn(out, F.min(F.when(F.col("__w") == 0, F.col("__at"))).over(later)).where("__w = 1")
    return source.join(found.select(F.col("__at").alias(day), out), day, "left")


def shift_sessions(days: DataFrame, n: int) -> DataFrame:
    """Sessions with the day n sessions before (after, for a negative n)."""
    w = Window.orderBy("day")
    return days.select("day", (F.lag("day", n) if n >= 0 else F.lead("day", -n)).over(w).alias("shifted_day"))


def month_ends(days: DataFrame) -> DataFrame:
    """First and last session and the number of sessions of each month."""
    return days.groupBy(F.trunc("day", "month").alias("month")).agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count(F.lit(1)).alias("n_sessions"))


def session_runs(days: DataFrame, present: DataFrame) -> DataFrame:
    """Unbroken runs of sessions that are in ``present`` (day): from, to and length."""
    numbered = calendar(days).join(present.select("day").distinct(), "day", "left_semi")
    group = F.col("session") - F.row_number().over(Window.orderBy("session"))
    return numbered.select("day", group.alias("g")).groupBy("g").agg(F.min("day").alias("from_day"), F.max("day").alias("to_day"), F.count(F.lit(1)).alias("n_sessions")).drop("g")


def listed(grid: DataFrame, entities: DataFrame) -> DataFrame:
    """Grid rows between each entity's listing and delisting (open where NULL); one equi-join, then a filter."""
    spans = entities.select("code", "list_day", "delist_day")
    inside = F.col("day").between(F.coalesce("list_day", F.lit("0001-01-01").cast("date")), F.coalesce("delist_day", F.lit("9999-12-31").cast("date")))
    return grid.join(spans, "code").where(inside).drop("list_day", "delist_day")


def to_wide(df: DataFrame, name: str, value: str, keys: list[str], names: list) -> DataFrame:
    """One column for each of ``names``. They are given, so no query for distinct values runs first."""
    if len(names) > 10_000:
        raise ValueError("too many columns for one wide table")
    return df.groupBy(*keys).pivot(name, names).agg(F.first(value, ignorenulls=True))


def to_long(df: DataFrame, keys: list[str], columns: list[str], name: str = "name", value: str = "value") -> DataFrame:
    return df.unpivot(keys, columns, name, value)


def on_sessions(df: DataFrame, days: DataFrame, day: str = "day") -> DataFrame:
    """Rows of trading days only."""
    return df.join(days.select(F.col("day").alias(day)).distinct(), day, "left_semi")


def session_places(days: DataFrame, wanted: DataFrame) -> DataFrame:
    """(day, session) of the wanted days; days that are no session have none (NULL)."""
    return wanted.select("day").distinct().join(calendar(days).select("day", "session"), "day", "left")


def day_mask(days: DataFrame, wanted: DataFrame, out: str = "wanted") -> DataFrame:
    """All sessions, and whether each is wanted."""
    marked = wanted.select("day", F.lit(True).alias(out)).distinct()
    return calendar(days).select("day", "session").join(marked, "day", "left").withColumn(out, F.coalesce(out, F.lit(False)))


def code_index(entities: DataFrame) -> DataFrame:
    """(code, place): columns of a matrix, from 0 in order of the code as text. Codes must be texts: numbers would lose leading zeros.

    The numbering runs over distinct entities, of which there are some thousands.
    """
    if dict(entities.dtypes)["code"] != "string":
        raise ValueError("codes must be texts")
    return entities.select("code").distinct().withColumn("place", F.row_number().over(Window.orderBy("code")) - 1)


def available_from(df: DataFrame, days: DataFrame, delay: int) -> DataFrame:
    """Rows of a table that comes ``delay`` sessions late, moved to the session on which they are there."""
    if not delay:
        return df
    numbered = calendar(days).select("day", "session")
    later = numbered.select(F.col("day").alias("__to"), (F.col("session") - delay).alias("session"))
    return df.join(numbered.join(later, "session").select("day", "__to"), "day").withColumn("day", F.col("__to")).drop("__to")
