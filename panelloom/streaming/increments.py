"""Increments as Structured Streaming: upserts, late rows, sessions, readiness and ledgers."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.sets import compare_fingerprints, fingerprint
from ..sources.tables import upsert


def file_stream(spark: SparkSession, path: str, schema: StructType, per_trigger: int = 100) -> DataFrame:
    """New Parquet files of a folder, or one named file, a bounded number for each micro-batch."""
    folder, _, name = path.rstrip("/").rpartition("/")
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger)
    if name.endswith(".parquet"):
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def tumbling(stream: DataFrame, time: str, width: str, keys: list[str], aggregates: list[Column], late: str) -> DataFrame:
    """Windows side by side; rows later than ``late`` behind the newest are dropped and counted by Spark."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(*aggregates)


def sliding(stream: DataFrame, time: str, width: str, step: str, keys: list[str], aggregates: list[Column], late: str) -> DataFrame:
    return stream.withWatermark(time, late).groupBy(F.window(time, width, step), *keys).agg(*aggregates)


def in_sessions(stream: DataFrame, time: str, gap: str, keys: list[str], aggregates: list[Column], late: str) -> DataFrame:
    return stream.withWatermark(time, late).groupBy(F.session_window(time, gap), *keys).agg(*aggregates)


def first_of_key(stream: DataFrame, time: str, keys: list[str], late: str) -> DataFrame:
    """Each key once within the lateness."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


class UpsertTable:
    """A table that micro-batches are merged into by key, exactly once.

    A batch rewrites the partitions it touches in a new version of them and then moves the pointer, so
    data comes before state. A batch that is given again after a failure finds its number in the
    pointer and changes nothing. All touched partitions are merged and written in one job.

    A row without a partition value has a partition of its own. Keys that do not hold the partition column
    may move: then a key's old row is looked for in all partitions, and those that lose one are rewritten, too.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], sort_by: list[str], partition: str):
        self.spark, self.root, self.keys, self.sort_by, self.partition = spark, root.rstrip("/"), keys, sort_by, partition

    def _pointer(self) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.root}/pointer")
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
                return None
            raise

    def last_batch(self) -> int:
        p = self._pointer()
        return -1 if p is None else p.agg(F.max("batch")).first()[0]

    def _current(self) -> dict[str, str]:
        """Path of the newest version of each partition: as many entries as partitions."""
        p = self._pointer()
        if p is None:
            return {}
        rows = p.groupBy("part").agg(F.max_by("path", "batch").alias("path")).collect()
        return {r["part"]: r["path"] for r in rows}

    def _load(self, paths: list[str]) -> DataFrame | None:
        if not paths:
            return None
        # the folder's column is a text: partition values must not be guessed into other types
        df = self.spark.read.option("mergeSchema", "true").option("basePath", self.root).parquet(*paths)
        return df.drop("__part", "__batch")

    def read(self) -> DataFrame | None:
        return self._load(sorted(set(self._current().values())))

    def _folder(self, column: Column) -> Column:
        """Name of a partition's folder: letters, digits and hyphens as they are, all else in hexadecimal."""
        text = column.cast("string")
        safe = F.when(text.rlike("^[A-Za-z0-9-]+$"), F.concat(F.lit("v-"), text)).otherwise(F.concat(F.lit("x-"), F.hex(F.encode(text, "UTF-8"))))
        return F.coalesce(safe, F.lit("null"))

    def merge(self, batch: DataFrame, number: int) -> None:
        if number <= self.last_batch():
            return
        current = self._current()
        batch = batch.persist()
        try:
            parts = {r[0] for r in batch.select(self._folder(F.col(self.partition)).alias("p")).distinct().collect()}
            if not parts:
                return
            if self.partition not in self.keys and current:
                before = self._load(sorted(set(current.values())))
                moved = before.join(batch.select(*self.keys).distinct(), self.keys, "left_semi").select(self._folder(F.col(self.partition)).alias("p")).distinct()
                parts |= {r[0] for r in moved.collect()}
            old = self._load([current[p] for p in sorted(parts) if p in current])
            merged = upsert(old, batch, self.keys, self.sort_by).withColumn("__part", self._folder(F.col(self.partition)))
            path = f"{self.root}/data/__batch={number:09d}"
            merged.repartition("__part").sortWithinPartitions("__part", *self.keys).write.mode("overwrite").partitionBy("__part").parquet(path)
            left = {r[0] for r in merged.select("__part").distinct().collect()}
            # a partition that has lost all rows stands on an empty version
            empty = f"{path}/__part=empty"
            if parts - left:
                merged.drop("__part").limit(0).coalesce(1).write.mode("overwrite").parquet(empty)
            rows = [(p, f"{path}/__part={p}" if p in left else empty, number) for p in sorted(parts)]
            self.spark.createDataFrame(rows, "part string, path string, batch long").coalesce(1).write.mode("append").parquet(f"{self.root}/pointer")
        finally:
            batch.unpersist()

    def sink(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Merge all that is there now, then stop."""
        return stream.writeStream.foreachBatch(self.merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def split_late(batch: DataFrame, day: str, newest: str, allowed_days: int) -> tuple[DataFrame, DataFrame]:
    """(rows to merge, rows that come too late): history before the allowed window is not changed."""
    floor = F.date_sub(F.lit(newest).cast("date"), allowed_days)
    return batch.where(F.col(day) >= floor), batch.where(F.col(day) < floor)


def update_ledger(old: DataFrame, rows: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """(new ledger, changes): hashes of the days in ``rows`` replace those in the ledger."""
    now = fingerprint(rows, by)
    changes = compare_fingerprints(old.join(now.select(*by), by, "left_semi"), now, by)
    return old.join(now.select(*by), by, "left_anti").unionByName(now), changes


def usual_delay(arrivals: DataFrame, last: int = 10, least: int = 3, cap: int = 2) -> DataFrame:
    """Delay of each table as its most frequent one among the last arrivals; only up, by ``cap`` at most."""
    from pyspark.sql import Window

    w = Window.partitionBy("table").orderBy(F.col("day").desc())
    recent = arrivals.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= last)
    counts = recent.groupBy("table", "delay", "declared").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("table", "declared").agg(F.sum("n").alias("seen"), F.max(F.struct("n", "delay")).alias("top"))
    raised = F.least(F.greatest(F.col("top.delay"), F.col("declared")), F.col("declared") + cap)
    return best.select("table", F.when(F.col("seen") >= least, raised).otherwise(F.col("declared")).alias("delay"))


def newest_complete_day(counts: DataFrame, reference: DataFrame, ratio: float = 0.7) -> DataFrame:
    """Newest day on which each table has ``ratio`` of its reference day's rows."""
    return counts.join(reference.select("table", F.col("n").alias("want")), "table").where(F.col("n") >= ratio * F.col("want")).groupBy("table").agg(F.max("day").alias("day"))


def gate(probe: Callable[[str], bool], tiers: dict[str, str], wait: Callable[[], None], tries: int, strict: bool = True) -> dict[str, str]:
    """Wait until the tables of tier ``wait`` are ready; ``watch`` is asked once, ``skip`` never.

    ``wait`` pauses between two rounds. When the rounds run out, a strict gate raises.
    """
    state = {t: "skipped" for t, tier in tiers.items() if tier == "skip"}
    state |= {t: "ready" if probe(t) else "late" for t, tier in tiers.items() if tier == "watch"}
    open_ = [t for t, tier in tiers.items() if tier == "wait"]
    for n in range(tries):
        open_ = [t for t in open_ if not probe(t)]
        if not open_:
            break
        if n + 1 < tries:
            wait()
    state |= {t: "late" if t in open_ else "ready" for t, tier in tiers.items() if tier == "wait"}
    if open_ and strict:
        raise TimeoutError(f"not ready: {open_}")
    return state


def calendar_gaps(rows: DataFrame, calendar: DataFrame, keys: list[str], day: str = "day") -> DataFrame:
    """Sessions between each key's first and last that have no row."""
    span = rows.groupBy(*keys).agg(F.min(day).alias("__a"), F.max(day).alias("__b"))
    listed = calendar.agg(F.sort_array(F.collect_set("day")).alias("__d"))
    want = span.join(F.broadcast(listed)).select(*keys, F.explode(F.filter("__d", lambda d: (d >= F.col("__a")) & (d <= F.col("__b")))).alias(day))
    return want.join(rows.select(*keys, day).distinct(), [*keys, day], "left_anti")


def checkpoint_path(root: str, name: str) -> str:
    return os.path.join(root, "checkpoints", name)


class TokenBucket:
    """Permission for requests: ``rate`` a second on the average and at most ``burst`` at once; the clock is a parameter."""

    def __init__(self, rate: float, burst: int, now: Callable[[], float]):
        self.rate, self.burst, self.now = rate, burst, now
        self.tokens, self.at = float(burst), now()

    def wait_for(self, n: int = 1) -> float:
        """Seconds to wait before n requests; they count as made."""
        t = self.now()
        self.tokens, self.at = min(self.burst, self.tokens + (t - self.at) * self.rate), t
        self.tokens -= n
        return max(0.0, -self.tokens / self.rate)

