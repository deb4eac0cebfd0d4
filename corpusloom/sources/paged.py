"""A paginated service as a data source of Spark, for batches and streams.

The service is an object of the caller's that Python can pickle, with

* ``bounds()``: the first and the last number of its range (of days, pages, shelves), or None if it is empty;
* ``count(first, last)``: how many results the numbers from first to last have;
* ``page(first, last, offset, size)``: the results from an offset on, as dicts; each has its number in the range column.

Ranges are halved until a range has ``most`` results at the most, level by level with the counts of a level side by side; each range is
a partition, read page by page. Filters on the range column narrow the range before anything is counted (with Spark's setting
``spark.sql.python.filterPushdown.enabled``). A stream's offset is the first number that hasn't been read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from corpusloom.sources.rest import MOST, retried

#: Counts that are asked for side by side.
AT_ONCE = 8


@dataclass
class Span(InputPartition):
    """Numbers from first to last and how many results they have."""

    first: int
    last: int
    count: int


def number_spans(count: Callable[[int, int], int], first: int, last: int, most: int = MOST) -> list[Span]:
    """Ranges with ``most`` results at the most, in order; a single number with more fails, as no range gives its other results."""
    out: list[Span] = []
    level = [(first, last)] if first <= last else []
    with ThreadPoolExecutor(AT_ONCE) as pool:
        while level:
            counts = list(pool.map(lambda r: retried(lambda: count(*r)), level))
            following = []
            for (a, b), n in zip(level, counts, strict=True):
                if n > most:
                    if a == b:
                        raise ValueError(f"{n} results for {a}, of which the service gives {most}")
                    middle = (a + b) // 2
                    following += [(a, middle), (middle + 1, b)]
                elif n:
                    out.append(Span(a, b, n))
            level = following
    return sorted(out, key=lambda s: s.first)


def _pages(service: Any, names: list[str], span: Span, size: int) -> Iterator[tuple]:
    for offset in range(0, span.count, size):
        for row in retried(lambda o=offset: service.page(span.first, span.last, o, min(size, span.count - o))):
            yield tuple(row.get(c) for c in names)


class _Reader(DataSourceReader):
    def __init__(self, service: Any, schema: StructType, column: str, most: int, size: int):
        self.service, self.names, self.column, self.most, self.size = service, schema.names, column, most, size
        self.least: int | None = None
        self.largest: int | None = None

    def pushFilters(self, filters: list) -> Iterator:
        for f in filters:
            if getattr(f, "attribute", None) == (self.column,) and isinstance(getattr(f, "value", None), int):
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    least = f.value + isinstance(f, GreaterThan)
                    self.least = least if self.least is None else max(self.least, least)
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    largest = f.value - isinstance(f, LessThan)
                    self.largest = largest if self.largest is None else min(self.largest, largest)
            yield f  # Spark tests the rows all the same

    def partitions(self) -> list[Span]:
        bounds = retried(self.service.bounds)
        if bounds is None:
            return []
        first = bounds[0] if self.least is None else max(bounds[0], self.least)
        last = bounds[1] if self.largest is None else min(bounds[1], self.largest)
        return number_spans(self.service.count, first, last, self.most)

    def read(self, partition: Span | None) -> Iterator[tuple]:
        return _pages(self.service, self.names, partition, self.size) if partition else iter(())


class _StreamReader(DataSourceStreamReader):
    def __init__(self, service: Any, schema: StructType, most: int, size: int):
        self.service, self.names, self.most, self.size = service, schema.names, most, size

    def initialOffset(self) -> dict:
        bounds = retried(self.service.bounds)
        return {"next": bounds[0] if bounds else 0}

    def latestOffset(self) -> dict:
        bounds = retried(self.service.bounds)
        return {"next": bounds[1] + 1 if bounds else 0}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        return number_spans(self.service.count, start["next"], end["next"] - 1, self.most)

    def read(self, partition: Span) -> Iterator[tuple]:
        return _pages(self.service, self.names, partition, self.size)

    def commit(self, end: dict) -> None:
        pass


def register_paged(spark: SparkSession, name: str, service: Any, schema: str, column: str, most: int = MOST, page_size: int = 200) -> None:
    """Make ``spark.read.format(name)`` and ``spark.readStream.format(name)`` read the service; ``column`` is the range column."""
    fields = schema

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return fields

        def reader(self, schema: StructType) -> DataSourceReader:
            return _Reader(service, schema, column, most, page_size)

        def streamReader(self, schema: StructType) -> DataSourceStreamReader:
            return _StreamReader(service, schema, most, page_size)

    spark.dataSource.register(Paged)


def stored_pages(df: DataFrame, column: str, path: str) -> None:
    """Rows as JSON lines in a folder for each number of the range column, with the numbers' counts beside them; what a
    ``FolderService`` serves. Rows without a number have no place."""
    rows = df.where(df[column].isNotNull())
    rows.withColumn("_number", rows[column]).write.mode("errorifexists").option("ignoreNullFields", "false").partitionBy("_number").json(f"{path}/pages")
    rows.groupBy(rows[column].alias("number")).count().coalesce(1).write.mode("errorifexists").json(f"{path}/counts")


class FolderService:
    """A service over a folder of ``stored_pages``, as a mirror of one that was downloaded. The folder is on a file system that
    pyarrow knows by its address and all machines reach."""

    def __init__(self, path: str):
        self.path = path
        self._counts: dict[int, int] | None = None

    def __getstate__(self) -> dict:
        return {"path": self.path, "_counts": None}

    def _lines(self, folder: str) -> Iterator[dict]:
        fs, at = pyarrow.fs.FileSystem.from_uri(f"{self.path}/{folder}")
        found = fs.get_file_info(pyarrow.fs.FileSelector(at, allow_not_found=True))
        for info in sorted(found, key=lambda i: i.path):
            if info.is_file and info.path.endswith(".json"):
                with fs.open_input_stream(info.path) as lines:
                    yield from (json.loads(line) for line in lines.read().decode().split("\n") if line)

    @property
    def counts(self) -> dict[int, int]:
        """Results by number."""
        if self._counts is None:
            self._counts = {r["number"]: r["count"] for r in self._lines("counts")}
        return self._counts

    def bounds(self) -> tuple[int, int] | None:
        return (min(self.counts), max(self.counts)) if self.counts else None

    def count(self, first: int, last: int) -> int:
        return sum(n for number, n in self.counts.items() if first <= number <= last)

    def page(self, first: int, last: int, offset: int, size: int) -> list[dict]:
        out: list[dict] = []
        for number in sorted(n for n in self.counts if first <= n <= last):
            if offset >= self.counts[number]:
                offset -= self.counts[number]
                continue
            rows = list(self._lines(f"pages/_number={number}"))
            out += rows[offset : offset + size - len(out)]
            offset = 0
            if len(out) >= size:
                break
        return out
