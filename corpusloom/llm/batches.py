"""Arrow batches of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa

from corpusloom.session import BATCH_BYTES, BATCH_ROWS, bounded as bounded


def emit(rows: Iterable[tuple], schema: pa.Schema, weigh: Callable[[tuple], int] = lambda row: 0) -> Iterator[pa.RecordBatch]:
    """Pack rows into record batches of at most BATCH_ROWS rows and about BATCH_BYTES weighed bytes."""
    held: list[tuple] = []
    weight = 0
    for row in rows:
        held.append(row)
        weight += weigh(row)
        if len(held) >= BATCH_ROWS or weight >= BATCH_BYTES:
            yield pack(held, schema)
            held, weight = [], 0
    if held:
        yield pack(held, schema)


def pack(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """One record batch of the rows."""
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.record_batch([pa.array(list(c), type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
