"""Stream forms over a table of several files, newest first, and in several micro-batches."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from telemill.plans.catalog import QUERIES
from telemill.plans.domain import Given
from telemill.streaming import ingest


def table(spark, folder):
    """Four parts, written newest first, each in the place of a micro-batch."""
    rows = spark.range(400).select(
        F.col("id").alias("event_id"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id as int))").alias("ts"),
        (F.col("id") % 15).alias("user_id"),
        F.when(F.col("id") % 3 == 0, "error").otherwise("signup").alias("event_type"),
        F.lit(1.0).alias("value"),
        F.lit("{}").alias("props"),
    )
    for part in (3, 2, 1, 0):
        rows.filter(f"event_id div 100 = {part}").coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
    return Given(spark, str(folder))


def test_stream_queries_read_folders(spark, tmp_path):
    given = table(spark, tmp_path)
    counts = {name: query.run(given).count() for name, query in QUERIES.items() if name.startswith("stream_")}
    assert len(counts) == 6 and counts.pop("stream_held_breaches") == 0 and min(counts.values()) > 0
    assert counts["stream_append"] == counts["stream_upsert"] == 400


def test_failure_windows_over_late_batches(spark, tmp_path):
    given = table(spark, tmp_path)
    runs = ingest.file_stream(spark, f"{tmp_path}/events.parquet", given.events.schema, 1).select(
        F.lit("all").alias("name"), F.col("event_type").alias("phase"), F.col("ts").alias("event_time")
    )

    def total(lateness, folder):
        counted = ingest.failure_windows(runs, F.col("phase") == "error", "6 hours", "1 hour", lateness)
        seen = {}

        def keep(batch, batch_id):
            seen.update({r.at: r.increase for r in batch.collect()})

        writer = counted.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{tmp_path}/{folder}")
        late = ingest.finish(spark, writer.trigger(availableNow=True).start, allow_late=True)
        return sum(seen.values()), late

    errors = given.events.filter("event_type = 'error'").count()
    assert total("60 days", "a") == (6 * errors, 0)
    assert total("0 seconds", "b")[1] > 0


def test_a_year_in_many_files_equals_the_batch(spark, tmp_path):
    """More micro-batches than a query remembers, newest first over a year: nothing is lost, and what would be is an error."""
    rows = spark.range(260).select(
        F.col("id").alias("event_id"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id * 3 div 2 as int))").alias("ts"),
        (F.col("id") % 15).alias("user_id"), F.lit("error").alias("event_type"), F.lit(1.0).alias("value"), F.lit("{}").alias("props"),
    )
    for part in reversed(range(130)):
        rows.filter(f"event_id div 2 = {part}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    given = Given(spark, str(tmp_path))
    runs = ingest.file_stream(spark, f"{tmp_path}/events.parquet", given.events.schema, 1).select(
        F.lit("all").alias("name"), F.col("event_type").alias("phase"), F.col("ts").alias("event_time")
    )
    counted = ingest.failure_windows(runs, F.col("phase") == "error", "1 hour", "1 hour", ingest.whole_span(given.events, "ts"))
    seen = {}

    def keep(batch, batch_id):
        seen.update({r.at: r.increase for r in batch.collect()})

    writer = counted.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{tmp_path}/a")
    assert ingest.finish(spark, writer.trigger(availableNow=True).start) == 0
    assert sum(seen.values()) == 260
    early = ingest.failure_windows(runs, F.col("phase") == "error", "1 hour", "1 hour", "1 second")
    writer = early.writeStream.outputMode("update").foreachBatch(lambda batch, i: batch.collect() and None).option("checkpointLocation", f"{tmp_path}/b")
    with pytest.raises(ingest.LateRowsError, match="258"):
        ingest.finish(spark, writer.trigger(availableNow=True).start)
