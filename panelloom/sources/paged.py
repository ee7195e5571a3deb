"""A paginated source as a Spark data source: one partition for each request range, pages read on executors."""

from __future__ import annotations

import json
import pickle
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: fetch(dataset, params, offset, limit) -> (rows, total): what a client for a service must offer.
Fetch = Callable[[str, dict, int, int], tuple[list[dict], int]]


class Range(InputPartition):
    def __init__(self, params: dict):
        self.params = params


def read_pages(fetch: Fetch, dataset: str, params: dict, page: int, tries: int = 3) -> Iterator[dict]:
    """All rows of a request, page by page; a short answer is asked for again, and at last refused."""
    for attempt in range(tries):
        rows, total, offset = [], None, 0
        while total is None or offset < total:
            got, total = fetch(dataset, params, offset, page)
            if not got:
                break
            rows += got
            offset += len(got)
        if total is not None and len(rows) >= total:
            yield from rows
            return
    raise OSError(f"{dataset} {params}: {len(rows)} of {total} rows after {attempt + 1} tries")


class PagedSource(DataSource):
    """``format("paged")`` with options dataset, ranges (JSON list of parameters), page and fetch (pickled, hex)."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        raise ValueError("give the schema of the rows with .schema()")

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options, schema)


class _Reader(DataSourceReader):
    def __init__(self, options, schema):
        self.dataset, self.page = options["dataset"], int(options.get("page", "1000"))
        self.ranges, self.fetch, self.names = json.loads(options["ranges"]), options["fetch"], [f.name for f in schema.fields]

    def partitions(self) -> list[Range]:
        return [Range(p) for p in self.ranges]

    def read(self, partition: Range) -> Iterator[tuple]:
        fetch = pickle.loads(bytes.fromhex(self.fetch))
        for row in read_pages(fetch, self.dataset, partition.params, self.page):
            yield tuple(row.get(n) for n in self.names)


def date_ranges(days: list[str], size: int) -> list[dict]:
    """Request ranges of ``size`` days each."""
    return [{"start": days[i], "end": days[min(i + size, len(days)) - 1]} for i in range(0, len(days), size)]


def entity_ranges(codes: list[str], size: int) -> list[dict]:
    return [{"codes": codes[i : i + size]} for i in range(0, len(codes), size)]
