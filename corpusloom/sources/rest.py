"""A source for paginated services: ranges of days, halved until each is small enough, are the partitions.

The service is an object of the caller's with ``count(query, start, end)`` and ``page(query, start, end, offset, size)``, so the
library itself opens no connection and tests need none.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date, timedelta
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: results that a service gives for one query.
MOST = 9_999


@dataclass(frozen=True)
class Span:
    """A range of days, as ISO dates, both included, and how many results it has."""

    start: str
    end: str
    count: int


def _halves(first: date, last: date) -> tuple[date, date] | None:
    """The last day of the first half of a range and the first day of the second: at a year's end, else in the middle of the
    year, else at a month's end, else at a day's; none for a single day."""
    if first == last:
        return None
    if first.year < last.year:
        end = date((first.year + last.year) // 2, 12, 31)
    elif (first.month, last.month) == (1, 12):
        end = date(first.year, 6, 30)
    elif first.month < last.month:
        end = date(first.year, (first.month + last.month) // 2 + 1, 1) - timedelta(days=1)
    else:
        end = first + (last - first) // 2
    return end, end + timedelta(days=1)


def spans(count: Callable[[str, str], int], first_year: int, last_year: int, most: int = MOST) -> list[Span]:
    """Ranges with ``most`` results at the most: a range with more is halved, by years, then half-years, months and days. A day
    with more fails, as the service gives no way to its other results."""
    out, todo = [], [(date(first_year, 1, 1), date(last_year, 12, 31))]
    while todo:
        first, last = todo.pop()
        n = count(first.isoformat(), last.isoformat())
        if n == 0:
            continue
        if n <= most:
            out.append(Span(first.isoformat(), last.isoformat(), n))
            continue
        parts = _halves(first, last)
        if parts is None:
            raise ValueError(f"{n} results on {first.isoformat()}, of which the service gives {most}")
        todo += [(parts[1], last), (first, parts[0])]
    return out


def retried(call: Callable[[], Any], attempts: int = 3, wait: float = 1.0) -> Any:
    """The call's result, tried again after growing pauses."""
    for i in range(attempts):
        try:
            return call()
        except Exception:
            if i == attempts - 1:
                raise
            time.sleep(wait * (i + 1))


def fetch(spark: SparkSession, service: Any, query: str, first_year: int, last_year: int, schema: str, page_size: int = 200, most: int = MOST) -> DataFrame:
    """All results of a query; each range is a task that reads its pages."""
    found = spans(lambda s, e: retried(lambda: service.count(query, s, e)), first_year, last_year, most)
    ranges = spark.createDataFrame([(s.start, s.end, s.count) for s in found], "start string, end string, n int").repartition(max(1, len(found)))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start, end, n in frame.itertuples(index=False):
                for offset in range(0, n, page_size):
                    rows = retried(lambda s=start, e=end, o=offset: service.page(query, s, e, o, min(page_size, n - o)))
                    if rows:
                        yield pd.DataFrame(rows)

    return ranges.mapInPandas(read, schema)


def looked_up(ids: DataFrame, lookup: Callable[[list[str]], list[dict | None]], column: str, schema: str, batch: int = 500) -> DataFrame:
    """Ids looked up in batches whose results come in the order of the ids; unknown ids give no row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keys = frame[column].tolist()
            for at in range(0, len(keys), batch):
                part = keys[at : at + batch]
                rows = [{column: k, **r} for k, r in zip(part, retried(lambda p=part: lookup(p)), strict=True) if r]
                if rows:
                    yield pd.DataFrame(rows)

    return ids.select(column).mapInPandas(run, schema)


def downloaded(ids: DataFrame, get: Callable[[str], bytes | None], column: str, done: DataFrame | None = None, tasks: int = 8, per_second: float = 9.0) -> DataFrame:
    """``id`` and ``content`` of every id that is not among those ``done`` (a column ``id``); ids without content give no row.

    ``tasks`` tasks share the rate: each waits so long after every call that all together make no more than ``per_second``.
    """
    wanted = ids.select(F.col(column).cast("string").alias("id")).distinct()
    if done is not None:
        wanted = wanted.join(done.select(F.col("id").cast("string").alias("id")), "id", "left_anti")
    pause = tasks / per_second

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for key in frame["id"]:
                began = time.monotonic()
                content = retried(lambda k=key: get(k))
                if content is not None:
                    yield pd.DataFrame({"id": [key], "content": [content]})
                time.sleep(max(0.0, pause - (time.monotonic() - began)))

    return wanted.repartition(tasks).mapInPandas(run, "id string, content binary")


def probed(sources: list[Callable[[], DataFrame]]) -> DataFrame:
    """The first of the sources that has any row, else the last."""
    for source in sources[:-1]:
        found = source()
        if not found.isEmpty():
            return found
    return sources[-1]()
