"""Time-windowed rules over run logs and gauges.

All rules aggregate to (name, step) first; what is kept per step does not grow with
the number of events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.operators.timeline import breach_runs

# Phases that count as a failure, and the longest allowed gap per schedule.
FAILED = ("Failed", "Error")
MAX_GAP_HOURS = {"nightly": 26, "dumps": 26, "maintenance": 8 * 24}


def step_counts(runs: DataFrame, step_s: int, failed: Column) -> DataFrame:
    """(name, step_start, n): failures per step."""
    start = F.window("event_time", f"{step_s} seconds")["start"]
    return runs.filter(failed).groupBy("name", start.alias("step_start")).agg(F.count("*").alias("n"))


def increase_over(counts: DataFrame, span_s: int, step_s: int, at_least: int) -> DataFrame:
    """(name, at, increase, breached) at each step end where the count over the span is not zero.

    Each step is counted for the ``span_s / step_s`` step ends that see it; only the
    counts are repeated, never the events.
    """
    step = F.make_dt_interval(secs=F.lit(step_s))
    last = F.col("step_start") + F.make_dt_interval(secs=F.lit(span_s))
    ends = F.explode(F.sequence(F.col("step_start") + step, last, step))
    total = counts.select("name", ends.alias("at"), "n").groupBy("name", "at")
    summed = total.agg(F.sum("n").alias("increase"))
    return summed.withColumn("breached", F.col("increase") >= at_least)


def absent(schedules: DataFrame, runs: DataFrame, now: Column) -> DataFrame:
    """(name, max_gap_hours, last_run, absent): schedules not triggered within their gap.

    ``schedules`` is one row per expected schedule; runs are aggregated before the join.
    """
    last = runs.groupBy("name").agg(F.max("event_time").alias("last_run"))
    gap = F.col("max_gap_hours") * F.lit(3600)
    age = F.unix_seconds(now) - F.unix_seconds(F.col("last_run").cast("timestamp"))
    return schedules.join(last, "name", "left").select(
        "name", "max_gap_hours", "last_run", (F.col("last_run").isNull() | (age >= gap)).alias("absent")
    )


def gauge_breaches(gauges: DataFrame, step_s: int, hold_s: int, breached: Column) -> DataFrame:
    """Runs of steps in which the group's maximum (column ``top``) breaches for ``hold_s``."""
    at = F.expr(f"unix_seconds(cast(event_time as timestamp)) div {step_s}L * {step_s}L")
    tops = gauges.groupBy("namespace", "job", at.alias("at")).agg(F.max("value").alias("top"))
    return breach_runs(tops, ["namespace", "job"], "at", breached, step_s, hold_s)
