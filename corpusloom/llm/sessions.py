"""Late session merging: every version of the sessions that events form while they come in, batch by batch.

After each batch, in ascending order, a user's events so far form sessions: neighbours in time at most ``gap`` apart share one.
A session that holds an event of the batch is a new version; it retracts the versions standing until then that it contains.

Events are summed up by user, cell (``gap`` of time) and batch where they lie, so a user's work grows with the time it is seen
in and not with its events: the events of one cell share a session at any time. Two sessions with more than a gap between them
when all events are in never meet before, so each of these last sessions is a unit of its own: the cells of a user are cut into
stretches of ``STRETCH``, breaks between cells are found within a stretch, and the last break of the earlier stretches comes
from one row for each of them. Within a unit a union-find runs over the cells: a batch's cells are activated and united with
their active predecessor and successor within the gap; roots carry extents, counts, sums and the standing versions.

Defined results: events without time or batch take no part; null users are one user; null values count as zero in sums; repeated
rows are events of their own; ties in time share a session; with a gap of zero only equal times do; an empty table gives an empty
result. Only the named columns are read, so others may have any names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.llm.batches import bounded, emit

#: Seconds between neighbours of a session, and cells of a stretch.
GAP, STRETCH = 600, 1024


class Sessions:
    """The union-find of one user's last session. A root is the first cell of its session."""

    def __init__(self, gap: int):
        self.gap = gap
        self.above: dict[int, int] = {}
        #: By root: first and last time, last cell, events, events of this batch, sum, standing versions.
        self.roots: dict[int, list] = {}

    def root(self, cell: int) -> int:
        above = self.above
        while above[cell] != cell:
            above[cell] = cell = above[above[cell]]
        return cell

    def add(self, cell: int, first: int, last: int, n: int, total: int) -> None:
        """A batch's events of one cell."""
        if cell in self.above:
            at = self.root(cell)
            own = self.roots[at]
            own[0], own[1] = min(own[0], first), max(own[1], last)
            own[3], own[4], own[5] = own[3] + n, own[4] + n, own[5] + total
        else:
            at = self.above[cell] = cell
            self.roots[cell] = [first, last, cell, n, n, total, []]
        # the neighbours within the gap can lie in the next cells only
        if cell == at and cell - 1 in self.above:
            at = self.unite(self.root(cell - 1), at)
        if self.roots[at][2] == cell and cell + 1 in self.above:
            self.unite(at, cell + 1)

    def unite(self, left: int, right: int) -> int:
        """One session of two neighbours if they are near enough; the root behind it that the right cells have."""
        a, b = self.roots[left], self.roots[right]
        if b[0] - a[1] > self.gap:
            return right
        self.above[right] = left
        more, fewer = (a[6], b[6]) if len(a[6]) >= len(b[6]) else (b[6], a[6])
        more += fewer
        self.roots[left] = [a[0], b[1], b[2], a[3] + b[3], a[4] + b[4], a[5] + b[5], more]
        del self.roots[right]
        return left


def versions(rows: Iterable[tuple[int, int, int, int, int, int]], gap: int) -> Iterator[tuple]:
    """The versions of one last session from its (batch, cell, first, last, events, sum) in the order of batches: batch, first
    and last time, events, new events, retracted versions, sum, and the batch and start of the version that retracts it."""
    sessions = Sessions(gap)
    held: list[tuple] = []

    def close() -> Iterator[tuple]:
        for at in {sessions.root(r[1]) for r in held}:
            own = sessions.roots[at]
            for old in own[6]:
                yield (*old, held[0][0], own[0])
            own[6] = [(held[0][0], own[0], own[1], own[3], own[4], len(own[6]), own[5])]
            own[4] = 0

    for row in rows:
        if held and held[0][0] != row[0]:
            yield from close()
            held = []
        sessions.add(*row[1:])
        held.append(row)
    if held:
        yield from close()
    for own in sessions.roots.values():
        for old in own[6]:
            yield (*old, None, None)


def session_versions(events: DataFrame, user: Column, time: Column, batch: Column, value: Column, gap: int = GAP) -> DataFrame:
    """Every version: ``user batch start_s end_s n_events n_new n_retracted h_sum retracted_batch retracted_start_s``. Times,
    batches and values are whole numbers; ``n_retracted`` is 0 for a new session, 1 for one that goes on, more for a merger."""
    if gap < 0:
        raise ValueError("gap is not negative")
    bounded(events.sparkSession)
    width = max(gap, 1)
    told = events.select(user.alias("user"), time.cast("bigint").alias("t"), batch.cast("bigint").alias("batch"), F.coalesce(value.cast("bigint"), F.lit(0)).alias("v")).where("t IS NOT NULL AND batch IS NOT NULL")
    cells = told.groupBy("user", F.expr(f"(t - pmod(t, {width})) div {width}").alias("cell"), "batch").agg(F.min("t").alias("first"), F.max("t").alias("last"), F.count("*").alias("n"), F.sum("v").alias("total"))
    cells = cells.withColumn("stretch", F.expr(f"(cell - pmod(cell, {STRETCH})) div {STRETCH}"))

    # where a last session begins: the latest break at or before a cell
    inside = Window.partitionBy("user", "stretch").orderBy("first", "last", "batch")
    upto = F.max("last").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("first") - upto > gap, F.col("first"))
    marked = cells.withColumn("begins", F.max(begins).over(inside.rowsBetween(Window.unboundedPreceding, 0))).withColumn("breaks", begins)
    ends = cells.groupBy("user", "stretch").agg(F.min("first").alias("from"), F.max("last").alias("to"))
    last_break = marked.groupBy("user", "stretch").agg(F.max("breaks").alias("last_break"))
    earlier = Window.partitionBy("user").orderBy("stretch")
    stretches = ends.join(last_break.withColumnsRenamed({"user": "of", "stretch": "s"}), F.col("user").eqNullSafe(F.col("of")) & (F.col("stretch") == F.col("s"))).drop("of", "s")
    stretches = stretches.withColumn("gone", F.lag("to").over(earlier)).withColumn("open", F.when(F.col("gone").isNull() | (F.col("from") - F.col("gone") > gap), F.col("from")))
    carried = F.max(F.greatest("open", F.coalesce("last_break", "open"))).over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    stretches = stretches.select(F.col("user").alias("of"), F.col("stretch").alias("s"), F.coalesce("open", carried).alias("carried"))
    units = marked.join(stretches, F.col("user").eqNullSafe(F.col("of")) & (F.col("stretch") == F.col("s"))).select("user", F.coalesce("begins", "carried").alias("unit"), "batch", "cell", "first", "last", "n", "total")
    units = units.repartition("user", "unit").sortWithinPartitions("user", "unit", "batch", "cell")

    kind = units.schema["user"].dataType
    names = ("batch", "start_s", "end_s", "n_events", "n_new", "n_retracted", "h_sum", "retracted_batch", "retracted_start_s")
    schema = pa.schema([("user", to_arrow_type(kind)), *((c, pa.int64()) for c in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        found = ((key[0], *v) for key, unit in groupby(rows, lambda r: r[:2]) for v in versions((r[2:] for r in unit), gap))
        yield from emit(found, schema)

    return units.mapInArrow(run, "user " + kind.simpleString() + "".join(f", {c} bigint" for c in names))
