"""Scans and sinks of keyed tables in Parquet, with their catalogue."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scalar import fin


@dataclass(frozen=True)
class Dataset:
    """What the catalogue knows of a table."""

    name: str
    keys: tuple[str, ...]
    day: str | None = None
    partition: str | None = "year"
    visible: tuple[str, ...] = ()  # days of which the latest is when a row could be known
    delay: int = 0  # sessions by which the table comes late
    must_know: str | None = None  # rows without it are not visible at all
    adjusted: bool = False  # rewritten in hindsight, so not for metrics
    code: str = "code"  # column of the entity


class Catalog:
    """Tables below a root folder."""

    def __init__(self, spark: SparkSession, root: str, datasets: list[Dataset] = (), cutoff: str | None = None):
        self.spark, self.root, self.cutoff = spark, root.rstrip("/"), cutoff
        self.datasets = {d.name: d for d in datasets}
        self.reads: set[str] = set()

    def scan(self, name: str, columns: list[str] | None = None, years: tuple[int, int] | None = None, days: tuple[str, str] | None = None, codes: list[str] | None = None) -> DataFrame:
        """The table with the wanted columns and rows; missing columns are an error.

        Year, day and code filters reach the scan: as pruned partitions and as Parquet filters.
        """
        self.reads.add(name)
        d = self.datasets.get(name, Dataset(name, ()))
        df = self.spark.read.parquet(f"{self.root}/{name}")
        absent = [c for c in columns or [] if c not in df.columns]
        if absent:
            raise ValueError(f"{name} has no column {absent}")
        if years and d.partition in df.columns:
            df = df.where(F.col(d.partition).between(*years))
        if days and d.day:
            df = df.where(F.col(d.day).between(*days))
        if codes is not None:
            df = df.where(F.col(d.code).isin(codes))
        if self.cutoff:
            df = as_of_cutoff(df, d, self.cutoff)
        return df.select(*columns) if columns else df


def clean_numbers(df: DataFrame) -> DataFrame:
    """NaN and infinities of all float columns as NULL."""
    return df.select(*[fin(F.col(f"`{n}`")).alias(n) if t in ("double", "float") else F.col(f"`{n}`") for n, t in df.dtypes])


def as_of_cutoff(df: DataFrame, dataset: Dataset, cutoff: str) -> DataFrame:
    """Only the rows that could be known on the day ``cutoff``; tables without any day are whole."""
    if dataset.must_know:
        df = df.where(F.col(dataset.must_know).isNotNull())
    days = [F.col(c) for c in (dataset.visible or ((dataset.day,) if dataset.day else ()))]
    if not days:
        return df
    return df.where((F.greatest(*days) if len(days) > 1 else days[0]) <= F.lit(cutoff).cast("date"))


def watermark(df: DataFrame, day: str) -> DataFrame:
    """Rows, newest day and number of files of a table; count and maximum come from file footers where Spark can."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.max(day).alias("max_day"), F.min(day).alias("min_day"))


def days_of(df: DataFrame, day: str) -> DataFrame:
    return df.groupBy(F.to_date(day).alias("day")).agg(F.count(F.lit(1)).alias("n_rows"))


def profile(df: DataFrame) -> DataFrame:
    """For each column: rows, NULLs, distinct values, smallest and largest as text. One pass over the table."""
    parts = []
    for n in df.columns:
        c = F.col(f"`{n}`")
        parts += [F.count(c), F.count_distinct(c), F.min(c).cast("string"), F.max(c).cast("string")]
    row = df.agg(F.count(F.lit(1)).alias("n"), *[p.alias(f"p{i}") for i, p in enumerate(parts)])
    lines = F.array(*[F.struct(F.lit(n).alias("name"), F.col("n").alias("n_rows"), (F.col("n") - F.col(f"p{4 * i}")).alias("n_null"), F.col(f"p{4 * i + 1}").alias("n_distinct"), F.col(f"p{4 * i + 2}").alias("low"), F.col(f"p{4 * i + 3}").alias("high")) for i, n in enumerate(df.columns)])
    return row.select(F.inline(lines))


def text_format(x: Column) -> Column:
    """Kind of a text value: day, month, time, integer, number, code or text."""
    kinds = [("day", r"^\d{4}-\d{2}-\d{2}$"), ("month", r"^\d{4}-\d{2}$"), ("time", r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}(:\d{2})?$"), ("integer", r"^-?\d+$"), ("number", r"^-?\d*\.\d+$"), ("code", r"^\w{1,6}\.\w{2}$")]
    return reduce(lambda e, k: e.when(x.rlike(k[1]), k[0]), kinds[1:], F.when(x.rlike(kinds[0][1]), kinds[0][0])).when(x.isNotNull(), "text")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def sampled_counts(df: DataFrame, column: str, fraction: float, seed: int = 7) -> DataFrame:
    """Estimated frequency of each value from a sample of rows (a sampling operator)."""
    return df.sample(fraction, seed).groupBy(column).agg((F.count(F.lit(1)) / fraction).alias("estimate"))


def unpack_dump(df: DataFrame, column: str = "dump") -> DataFrame:
    """Bars out of ``{code: [[time, open, high, low, close, vol, amount], …]}`` texts; of equal (code, time) the last."""
    kind = "map<string,array<array<string>>>"
    bars = df.select(F.explode(F.from_json(column, kind)).alias("code", "bars")).select("code", F.posexplode("bars").alias("at", "b"))
    names = ["open", "high", "low", "close", "vol", "amount"]
    rows = bars.select("code", F.get("b", 0).alias("time"), "at", *[F.get("b", i + 1).try_cast("double").alias(n) for i, n in enumerate(names)])
    w = Window.partitionBy("code", "time").orderBy(F.col("at").desc())
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n", "at")


def scaled_bars(bars: DataFrame, clock: str, wanted: list[int], factors: dict[str, float]) -> DataFrame:
    """Bars of the wanted clock times, with columns times their unit factors."""
    kept = bars.where(F.col(clock).isin(wanted))
    return kept.withColumns({c: F.col(c) * f for c, f in factors.items()})


# --- sinks -------------------------------------------------------------------------------------


def upsert(old: DataFrame | None, new: DataFrame, keys: list[str], sort_by: list[str]) -> DataFrame:
    """Old and new rows, one for each key: the newest; within one side the last by ``sort_by`` and then by content.

    Columns are the union, old ones first.
    """
    both = new.withColumn("__v", F.lit(1))
    if old is not None:
        both = old.withColumn("__v", F.lit(0)).unionByName(both, allowMissingColumns=True)
    columns = [c for c in both.columns if c != "__v"]
    rest = F.xxhash64(*columns)
    w = Window.partitionBy(*keys).orderBy(F.col("__v").desc(), *[F.col(c).desc_nulls_last() for c in sort_by], rest)
    return both.withColumn("__n", F.row_number().over(w)).where("__n = 1").select(*columns)


def replace_days(old: DataFrame, new: DataFrame, days: DataFrame, before: str | None = None, after: str | None = None) -> DataFrame:
    """Old rows of other days and all new rows, cut to the days from ``after`` to ``before``."""
    kept = old.join(days.select("day").distinct(), "day", "left_anti").unionByName(new, allowMissingColumns=True)
    if before:
        kept = kept.where(F.col("day") <= F.lit(before).cast("date"))
    return kept.where(F.col("day") >= F.lit(after).cast("date")) if after else kept


def check_contract(df: DataFrame, contract: StructType) -> DataFrame:
    """``df``, or an error where names, order or types differ from the contract."""
    want, have = [(f.name, f.dataType.simpleString()) for f in contract.fields], df.dtypes
    if want != have:
        raise ValueError(f"schema {have} is not the contract {want}")
    return df


def write_partitions(df: DataFrame, path: str, partition: str = "year", sort_by: list[str] = (), parts: int = 8) -> None:
    """Replace the partitions that ``df`` holds and leave the others; files are sorted inside.

    A partition value's rows are dealt to ``parts`` tasks, by ranges of the sort columns where there are any, so
    a large year is not one task. The output committer moves whole partitions in when the job is done.
    """
    if sort_by:
        dealt = df.repartitionByRange(parts * df.sparkSession.sparkContext.defaultParallelism, partition, *sort_by).sortWithinPartitions(partition, *sort_by)
    else:
        dealt = df.withColumn("__salt", F.pmod(F.xxhash64(*df.columns), F.lit(parts))).repartition(partition, "__salt").drop("__salt")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(partition).parquet(path)


def replace_snapshot(df: DataFrame, path: str, floor: float = 0.9) -> None:
    """Replace a whole table, unless the new one has less than ``floor`` of the old one's rows."""
    spark = df.sparkSession
    try:
        old = spark.read.parquet(path).count()
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        old = 0
    n = df.count()
    if n < floor * old:
        raise ValueError(f"{n} rows would replace {old}")
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


class WriteBuffer:
    """Collects frames for one table and writes them in few, large steps.

    It flushes when the rows that wait are ``least`` or a ``share`` of the rows already written, whichever is
    more: the steps grow with the table, so that its rows are rewritten a bounded number of times each.
    """

    def __init__(self, write: Callable[[DataFrame], None], least: int = 300_000, share: float = 0.25, written: int = 0):
        self.write, self.least, self.share, self.written = write, least, share, written
        self.waiting: list[DataFrame] = []
        self.rows = self.flushes = 0

    def add(self, df: DataFrame, rows: int | None = None) -> None:
        self.waiting.append(df)
        self.rows += df.count() if rows is None else rows
        if self.rows >= max(self.least, self.share * self.written):
            self.flush()

    def flush(self) -> None:
        if self.waiting:
            self.write(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), self.waiting))
            self.written, self.flushes = self.written + self.rows, self.flushes + 1
            self.waiting, self.rows = [], 0


def with_variant(df: DataFrame, **literals) -> DataFrame:
    """``df`` with what the request said (market, frequency, kind) as literal columns."""
    return df.withColumns({k: F.lit(v) for k, v in literals.items()})


def latest_rows(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """The n newest rows of each key, by ``order`` and then by content."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order], F.xxhash64(*df.columns))
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).drop("__n")


def in_pool(df: DataFrame, pool: DataFrame, key: str) -> DataFrame:
    """Rows whose entity is in the pool."""
    return df.join(pool.select(key).distinct(), key, "left_semi")


def without_suffixes(df: DataFrame, key: str, banned: DataFrame, suffix: str, length: int) -> DataFrame:
    """Rows whose key does not end in one of the banned suffixes of ``length`` characters: an anti join on the suffix."""
    return df.join(banned.select(F.col(suffix).alias("__s")).distinct(), F.right(F.col(key), F.lit(length)) == F.col("__s"), "left_anti")


def cast_like(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` in its order, cast where they can be, NULL where absent; further columns follow."""
    known = {f.name for f in schema.fields}
    return df.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields], *[c for c in df.columns if c not in known])


@dataclass
class Quality:
    """Findings of the audits of one table."""

    gaps: DataFrame
    foreign_days: DataFrame
    duplicates: DataFrame
    counts: DataFrame = field(repr=False, default=None)


def audit(df: DataFrame, calendar: DataFrame, keys: list[str], day: str = "day") -> Quality:
    """Sessions without rows, rows outside the calendar, keys that occur twice."""
    have = df.select(F.col(day).alias("day")).distinct()
    inside = calendar.join(df.agg(F.min(day).alias("__a"), F.max(day).alias("__b"))).where("day between __a and __b").select("day")
    return Quality(inside.join(have, "day", "left_anti"), have.join(calendar, "day", "left_anti"), duplicate_keys(df, keys), df.groupBy(day).count())


def magnitude_jumps(df: DataFrame, x: str, factor: float = 5.0) -> DataFrame:
    """Days whose cross-section median is ``factor`` times the one before, or a ``factor``-th of it."""
    daily = df.groupBy("day").agg(F.percentile(x, 0.5).alias("median"))
    w = Window.orderBy("day")
    ratio = F.col("median") / F.lag("median").over(w)
    return daily.withColumn("ratio", ratio).where((F.col("ratio") >= factor) | (F.col("ratio") <= 1 / factor))


_local: dict[str, str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; local sessions without that setting get one of their own."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _local:
            _local[app] = tempfile.mkdtemp(prefix="panelloom-")
            atexit.register(shutil.rmtree, _local[app], ignore_errors=True)
        base = f"file://{_local[app]}"
    return f"{base.rstrip('/')}/panelloom/{name}-{uuid.uuid4().hex[:12]}"
