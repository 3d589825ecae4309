"""Structured Streaming forms of the incremental jobs.

Each batch form and its stream form give the same table once all input is read.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from telemill.plans.lake import Lake


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """New Parquet files of a landing folder; the checkpoint is the per-file mark."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    )


def upsert_stream(
    lake: Lake, stream: DataFrame, table: str, name: str, checkpoint: str, key: str = "job_id",
    cursor: tuple[str, str] | None = None,
) -> StreamingQuery:
    """Merge every micro-batch; a replayed batch finds its commit and does nothing."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        run_id = f"{name}-{batch_id}"
        if not lake.already_done(table, run_id):
            lake.upsert(table, batch, key=key, cursor=cursor, run_id=run_id)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_stream(lake: Lake, stream: DataFrame, table: str, name: str, checkpoint: str) -> StreamingQuery:
    """Append every micro-batch once: the commit carries the batch id."""

    def add(batch: DataFrame, batch_id: int) -> None:
        lake.append(table, batch, run_id=f"{name}-{batch_id}")

    return (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def distinct_probes(stream: DataFrame, lateness: str) -> DataFrame:
    """One row per (hostname, last_updated); rows later than ``lateness`` are dropped."""
    timed = stream.withColumn("event_time", F.timestamp_seconds("last_updated"))
    return timed.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(
        ["hostname", "last_updated"]
    )


def failure_windows(runs: DataFrame, failed: Column, span: str, step: str, lateness: str) -> DataFrame:
    """(name, at, increase): failures per sliding window, state bounded by the lateness."""
    timed = runs.withColumn("event_time", F.col("event_time").cast("timestamp"))
    frame = F.window("event_time", span, step)
    counted = (
        timed.filter(failed)
        .withWatermark("event_time", lateness)
        .groupBy("name", frame.alias("w"))
        .agg(F.count("*").alias("increase"))
    )
    return counted.select("name", F.col("w.end").alias("at"), "increase")


class LateRowsError(RuntimeError):
    """A stream left rows out because they came later than its lateness allows."""


class _Dropped(StreamingQueryListener):
    """Rows that each run of a query left out as too late, over all its batches."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.batch: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        self.rows[run] = self.rows.get(run, 0) + sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)
        self.batch[run] = event.progress.batchId

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.batch[str(event.runId)] = 1 << 62


def finish(spark: SparkSession, start: Callable[[], StreamingQuery], allow_late: bool = False, patience_s: float = 60) -> int:
    """Start a query, wait for its end, and give the number of rows that came too late.

    All batches are counted, by a listener: a query itself remembers only the last ones. Above zero is an error
    unless ``allow_late``.
    """
    dropped = _Dropped()
    spark.streams.addListener(dropped)
    try:
        query = start()
        query.awaitTermination()
        run, waited = str(query.runId), 0.0
        while dropped.batch.get(run, -1) < 1 << 62 and waited < patience_s:  # the end is the last event of a run
            time.sleep(0.05)
            waited += 0.05
    finally:
        spark.streams.removeListener(dropped)
    late = dropped.rows.get(run, 0)
    if late and not allow_late:
        raise LateRowsError(f"{late} row(s) came later than the stream's lateness allows")
    return late


def whole_span(rows: DataFrame, at: str) -> str:
    """A lateness that no row of a table exceeds, in whatever order its files come: the span of its own times."""
    seconds = F.unix_seconds(F.col(at).cast("timestamp"))
    span = rows.agg(F.max(seconds) - F.min(seconds)).first()[0]
    return f"{(span or 0) + 1} seconds"


def write_available(stream: DataFrame, target: str, checkpoint: str, mode: str = "append", allow_late: bool = False) -> int:
    """Run a stream over all input there is and stop; output as Parquet. Returns how many rows came too late."""
    writer = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    return finish(stream.sparkSession, writer.outputMode(mode).trigger(availableNow=True).start, allow_late)
