"""Incremental forms: append what is new, remember what is done, running budgets and windows over event time."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener

from corpusloom.session import scratch_path
from corpusloom.sources.readers import first_that_exists


def file_stream(spark: SparkSession, path: str, schema: Any) -> DataFrame:
    """New Parquet files of a folder, as they come; a checkpoint remembers those that are done."""
    return spark.readStream.schema(schema).parquet(path)


def run_available(stream: DataFrame, label: str, output: str = "append", checkpoint: str | None = None) -> DataFrame:
    """Process what is there now, write it as Parquet to the shared folder and read it back.

    The sink keeps complete results by overwriting them in each batch, and appends others.
    """
    spark = stream.sparkSession
    path, checkpoint = scratch_path(spark, label), checkpoint or scratch_path(spark, f"{label}-checkpoint")
    mode = "overwrite" if output == "complete" else "append"

    def put(batch: DataFrame, number: int) -> None:
        # a batch that is tried again replaces its own files only
        batch.write.mode("overwrite").parquet(path if mode == "overwrite" else f"{path}/batch={number}")

    stream.writeStream.outputMode(output).foreachBatch(put).trigger(availableNow=True).option("checkpointLocation", checkpoint).start().awaitTermination()
    if not first_that_exists(spark, path):
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(path if mode == "overwrite" else f"{path}/batch=*")


def first_seen(stream: DataFrame, keys: list[str], event_time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Rows whose key hasn't come before; with an event time, keys are forgotten after the delay."""
    if event_time is None:
        return stream.dropDuplicates(keys)
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def tumbling_counts(stream: DataFrame, event_time: str, width: str, groups: list[Column], delay: str) -> DataFrame:
    """Rows of every window and group."""
    told = stream.withWatermark(event_time, delay).groupBy(F.window(event_time, width).alias("w"), *groups).agg(F.count("*").alias("n"))
    return told.select(F.col("w.start").alias("window_start"), *[c for c in told.columns if c != "w"])


def session_counts(stream: DataFrame, event_time: str, gap: str, key: str, delay: str) -> DataFrame:
    """Rows of every session of a key."""
    told = stream.withWatermark(event_time, delay).groupBy(F.session_window(event_time, gap).alias("w"), key).agg(F.count("*").alias("n"))
    return told.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), key, "n")


#: The state store that keyed state with timers and expiry needs.
STORE_SETTING, STORE = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Budget(StatefulProcessor):
    """Rows of a key, in order within a batch, until their tokens reach the limit, the crossing row included.

    What a key has spent is a value of the state store. ``keep_ms`` is how long it is kept after it last changed (the store then
    forgets it by itself), ``idle_ms`` how long after the key was last seen (a timer). Of a batch's rows a task holds
    those that may still fit, never all rows of a key.
    """

    def __init__(self, order: str, tokens: str, limit: int, keep_ms: int | None = None, idle_ms: int | None = None):
        self.order, self.tokens, self.limit, self.keep_ms, self.idle_ms = order, tokens, limit, keep_ms, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spent = handle.getValueState("spent", "tokens bigint", ttlDurationMs=self.keep_ms)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        known = self.spent.get()
        spent, held = known[0] if known else 0, None
        for frame in rows:
            if spent >= self.limit:
                continue  # the key's budget is spent; what is left of the batch is read to its end
            held = self.fitting(frame if held is None else pd.concat([held, frame]), spent)
        if held is not None and len(held):
            self.spent.update((int(spent + held[self.tokens].fillna(0).sum()),))
            yield held
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)

    def fitting(self, frame: pd.DataFrame, spent: int) -> pd.DataFrame:
        """The first rows in order (nulls first) that start below the limit."""
        frame = frame.sort_values(self.order, kind="stable", na_position="first")
        size = frame[self.tokens].fillna(0)
        return frame[spent + size.cumsum() - size < self.limit]

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.spent.clear()
        return iter(())

    def close(self) -> None:
        pass


def budgeted(stream: DataFrame, key: str, order: str, tokens: str, limit: int, keep_ms: int | None = None, idle_ms: int | None = None) -> DataFrame:
    """The stream's rows that stay within each key's budget, over all batches. The session must use the RocksDB state store.

    With ``keep_ms`` or ``idle_ms`` the query goes by processing time and needs a trigger that goes on, as ``availableNow`` would
    wait for timers without end."""
    timed = "ProcessingTime" if keep_ms is not None or idle_ms is not None else "None"
    own = {c: f"c{i}" for i, c in enumerate(stream.columns)}  # names that pandas and Python take as they are
    plain = stream.toDF(*own.values())
    return plain.groupBy(own[key]).transformWithStateInPandas(Budget(own[order], own[tokens], limit, keep_ms, idle_ms), plain.schema, "Append", timed).toDF(*stream.columns)


def run_budget(stream: DataFrame, key: str, order: str, tokens: str, limit: int, label: str, checkpoint: str | None = None) -> DataFrame:
    """``budgeted`` over what is there now; gives the rows that were kept. What keys have spent is part of the checkpoint, so a
    later run goes on with it, and a batch that is tried again starts where it started; a checkpoint that lacks a part of its
    state fails, as the store's versions follow those of the batches."""
    spark = stream.sparkSession
    before = spark.conf.get(STORE_SETTING)
    spark.conf.set(STORE_SETTING, STORE)
    try:
        return run_available(budgeted(stream, key, order, tokens, limit), label, checkpoint=checkpoint)
    finally:
        spark.conf.set(STORE_SETTING, before)


def each_batch(process: Callable[[DataFrame], DataFrame], path: str) -> Callable[[DataFrame, int], None]:
    """A sink that processes every batch and writes it to a folder of its own, so a batch tried again leaves one copy."""

    def put(batch: DataFrame, number: int) -> None:
        process(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return put


def appended(stream: DataFrame, process: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, tell: Callable[[dict[str, Any]], None] | None = None) -> None:
    """Process what is there now, batch by batch, append it below ``path`` and tell the rows of each batch; what the checkpoint
    has as done is not read again."""
    spark, sink = stream.sparkSession, each_batch(process, path)

    def put(batch: DataFrame, number: int) -> None:
        sink(batch, number)
        if tell is not None:
            tell({"batch": number, "rows": spark.read.parquet(f"{path}/batch={number}").count()})

    stream.writeStream.foreachBatch(put).trigger(availableNow=True).option("checkpointLocation", checkpoint).start().awaitTermination()


class Progress(StreamingQueryListener):
    """Tells every batch (``batch``, ``rows``, ``rows_per_second``) of the session's streams, once added to ``spark.streams``."""

    def __init__(self, tell: Callable[[dict[str, Any]], None]):
        self.tell = tell

    def onQueryStarted(self, event: Any) -> None:
        pass

    def onQueryProgress(self, event: Any) -> None:
        p = event.progress
        self.tell({"batch": p.batchId, "rows": p.numInputRows, "rows_per_second": p.processedRowsPerSecond})

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        pass
