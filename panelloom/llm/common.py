"""Helpers shared by the training-data operators: scratch tables, batches, document tables."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import islice

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
#: Longer words are not remembered between batches.
LONG_WORD = 64
#: What operators keep in a Python worker from task to task, by owner: that which drops it.
_warm: dict[str, Callable[[], None]] = {}
#: Rows of a batch for Python in jobs that write tables.
BATCH_ROWS = 1_000


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors share.

    Where that setting is unset only a local session may go on, with a folder of its own that is
    removed when Python ends.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = tempfile.mkdtemp(prefix="panelloom-")
            atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
        base = f"file://{_own[app]}"
    return f"{base.rstrip('/')}/panelloom/{name}-{uuid.uuid4().hex[:12]}"


def files_for(spark: SparkSession, rows: int, per_file: int = 100_000, least: int | None = None) -> int:
    """Files for a table of at most ``rows`` rows: ``least``, two for each core unless given, and more as it grows."""
    return max(2 * spark.sparkContext.defaultParallelism if least is None else least, -(-rows // per_file))


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs in this context pass at most ``BATCH_ROWS`` rows to Python at once: whole texts may be long, and neighbours of their like."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if 0 < int(before) <= BATCH_ROWS:
        yield
        return
    spark.conf.set(name, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def materialize(df: DataFrame, name: str, files: int | None = None, group_bytes: int | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage ends there.

    With ``files``, the write has no more tasks than that, each with several shuffle partitions. With
    ``group_bytes``, row groups have that size, so that readers can split a file that holds much.
    """
    path = scratch_dir(df.sparkSession, name)
    if files is not None:
        df = df.coalesce(files)
    with small_batches(df.sparkSession):
        to = df.write
        if group_bytes is not None:  # few rows may hold much, so their sizes are looked at from the first on
            to = to.option("parquet.block.size", group_bytes).option("parquet.block.size.row.check.min", 1).option("parquet.page.size.row.check.min", 1)
        to.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, or with marks behind it where ``df`` has a column of that name (in whatever case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def portions(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1_000_000, rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``limit`` bytes, and at most ``rows`` rows, in each piece."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        lengths = values.is_null().to_pylist() if values.type == pa.null() else pa.compute.binary_length(values).fill_null(0).to_pylist()
        begin = size = 0
        for i, n in enumerate(lengths):
            if i > begin and (size + n > limit or i - begin == rows):
                yield batch.slice(begin, i - begin)
                begin, size = i, 0
            size += n
        yield batch.slice(begin)


def keep_warm(owner: str, drop: Callable[[], None]) -> None:
    """``owner`` keeps something in this worker until a task of another operator begins, which calls ``drop``."""
    _warm[owner] = drop


def drop_others(owner: str | None) -> None:
    for name in [n for n in _warm if n != owner]:
        _warm.pop(name)()


def give_back() -> None:
    """Free memory of this process goes back to the system; allocators would keep it while the worker is idle."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], owner: str | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow in a worker that other operators use, too: it drops what they keep and leaves no free memory behind."""

    def call(batches):
        drop_others(owner)
        try:
            yield from run(batches)
        finally:
            give_back()

    return call


def ids_of_words(texts: list[list[str]], cache: dict[str, bytes], learn: Callable[[set[str]], None], limit: int) -> list[bytes]:
    """Each text's words replaced by what ``cache`` holds for them, joined; ``learn`` adds what it lacks.

    Over ``limit`` words the cache keeps its oldest third, in which the frequent words are. Words over
    ``LONG_WORD`` characters leave it after the batch, so that its bytes are bounded as well.
    """
    found = [list(map(cache.get, words)) for words in texts]
    new = {w for words, own in zip(texts, found, strict=True) if None in own for w, x in zip(words, own, strict=True) if x is None}
    if new and len(cache) + len(new) > limit:
        for old in list(islice(cache, limit // 3, None)):
            del cache[old]
    learn(new)
    out = []
    for words, own in zip(texts, found, strict=True):
        if None in own:
            own = [cache[w] if x is None else x for w, x in zip(words, own, strict=True)]
        out.append(b"".join(own))
    for word in new:
        if len(word) > LONG_WORD:
            cache.pop(word, None)
    return out
