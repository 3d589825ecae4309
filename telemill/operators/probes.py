"""Probe rows: duplicates, late rows and the join to job traces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemill.operators.timeline import asof_join

HOUR_MS = 3_600_000


def distinct_on_read(probes: DataFrame) -> DataFrame:
    """One row per (hostname, last_updated) of an append-only table."""
    return probes.dropDuplicates(["hostname", "last_updated"])


def not_late(probes: DataFrame, saved: int | None) -> DataFrame:
    """Rows at or after the saved row cursor; the first run keeps all rows."""
    return probes if saved is None else probes.filter(F.col("last_updated") >= F.lit(saved))


def host_at_start(
    trace: DataFrame, probes: DataFrame, columns: list[str], bucket_hours: int = 1
) -> DataFrame:
    """Each trace with the newest probe of its host strictly before the job started.

    Traces count milliseconds and probes seconds; both are compared in milliseconds.
    """
    in_ms = probes.withColumn("probe_ms", F.col("last_updated") * 1000).withColumnRenamed("hostname", "host")
    joined = asof_join(
        trace, in_ms, "host", "startedtimestamp", "probe_ms",
        ["last_updated", *columns], bucket_hours * HOUR_MS,
    )
    return joined.drop("probe_probe_ms")
