"""Queries on the forms that keep hot keys and small sides in bounds, and on alerts as streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemill.operators import membership, retention, timeline
from telemill.plans.domain import SQL, Given, ctes
from telemill.plans.queries_lake import CUTOFF
from telemill.plans.registry import query
from telemill.session import scratch, ship
from telemill.streaming import alerts, ingest


@query(
    ctes("job_info", "lake_keys")
    + """SELECT j.job_id, k.job_id IS NOT NULL AS verified FROM job_info j LEFT JOIN lake_keys k USING (job_id)
    WHERE j.last_update < TIMESTAMP '1998-03-01' AND j.job_id % 50 = 0"""
)
def presence_pruned(given: Given) -> DataFrame:
    """Few candidates against a large lake: its keys pass a Bloom filter of the candidates before the exact join."""
    candidates = retention.old_jobs(given.job_info.filter("job_id % 50 = 0"), CUTOFF)
    return membership.presence_pruned(candidates, given.lake_keys)


@query(
    """WITH s AS (SELECT event_type || (CASE WHEN user_id % 3 = 0 THEN user_id ELSE 0 END) AS series,
      floor(epoch(ts))::BIGINT AS "at", event_id % 50 AS total FROM events),
    w AS (SELECT *, lag(total) OVER (PARTITION BY series ORDER BY "at", total) AS before FROM s)
    SELECT series, "at", total, CASE WHEN before IS NULL THEN NULL WHEN total >= before THEN total - before ELSE total END AS increase
    FROM w"""
)
def counter_increase_by_ranges(given: Given) -> DataFrame:
    """Counter increases where a few series hold most samples: a series is cut between tasks."""
    kind = F.when(F.col("user_id") % 3 == 0, F.col("user_id")).otherwise(0).cast("string")
    samples = given.events.select(
        F.concat("event_type", kind).alias("series"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("at"), (F.col("event_id") % 50).alias("total")
    )
    return timeline.counter_increase_by_ranges(samples, "series", "at", "total")


@query(
    f"""WITH f AS (SELECT job_id, CASE WHEN job_id % 2 = 0 THEN 'wn0001' ELSE host END AS host, startedtimestamp FROM ({SQL['starts']})),
    p AS (SELECT hostname AS host, last_updated * 1000 AS at, last_updated, max(probe_id) AS probe_id FROM ({SQL['probes']}) GROUP BY ALL)
    SELECT f.job_id, f.host, f.startedtimestamp, p.last_updated, p.probe_id
    FROM f ASOF LEFT JOIN p ON f.host = p.host AND f.startedtimestamp > p.at"""
)
def probe_at_start_hot(given: Given) -> DataFrame:
    """The as-of join where one host has half of all job starts; its groups are split before any start is shuffled."""
    host = F.when(F.col("job_id") % 2 == 0, "wn0001").otherwise(F.col("host"))
    starts = given.starts.withColumn("host", host)
    probes = given.probes.withColumn("probe_ms", F.col("last_updated") * 1000).withColumnRenamed("hostname", "host")
    joined = timeline.asof_join(starts, probes, "host", "startedtimestamp", "probe_ms", ["last_updated", "probe_id"], 6 * 3_600_000, facts_per_group=20)
    return joined.select("job_id", "host", "startedtimestamp", "last_updated", "probe_id")


# ---- alerts as streams ------------------------------------------------------------------------------------

_SCHEDULES = [("flow_0", 26), ("flow_1", 1), ("flow_2", 192), ("flow_9", 26)]


def _fed(given: Given, rows: DataFrame, rule: Callable[[DataFrame], DataFrame], clock: DataFrame) -> DataFrame:
    """The output of a rule over rows that land in order of time, in several batches, with a restart between them.

    The last row to land is a key of its own far ahead in time: it lets all timers fire.
    """
    ship(given.spark)
    root = scratch(given.spark, "alerts")
    span = rows.agg(F.min("event_time").alias("lo"), F.max("event_time").alias("hi")).first()
    third = (span.hi - span.lo) / 3
    parts = [rows.filter(F.col("event_time") < span.lo + third), rows.filter((F.col("event_time") >= span.lo + third) & (F.col("event_time") < span.lo + 2 * third))]
    parts += [rows.filter(F.col("event_time") >= span.lo + 2 * third), clock]
    with alerts.timers(given.spark):
        for some in (parts[:2], parts[2:]):
            for part in some:
                part.coalesce(1).write.mode("append").parquet(f"{root}/feed")
            stream = ingest.file_stream(given.spark, f"{root}/feed", rows.schema, 1)
            ingest.write_available(rule(stream), f"{root}/out", f"{root}/state")
    return given.spark.read.parquet(f"{root}/out")


@query(
    ctes("runs")
    + """, s(name, gap) AS (VALUES ('flow_0', 26), ('flow_1', 1), ('flow_2', 192), ('flow_9', 26)),
    t AS (SELECT DISTINCT name, epoch_us(event_time) // 1000 AS ms FROM runs),
    o AS (SELECT min(ms) AS since FROM t),
    pairs AS (SELECT name, lag(ms) OVER w AS last, ms AS next FROM t WINDOW w AS (PARTITION BY name ORDER BY ms)
      UNION ALL SELECT s.name, max(ms), NULL FROM s LEFT JOIN t ON t.name = s.name GROUP BY s.name)
    SELECT p.name, last AS last_run_ms, (coalesce(last, since) + gap * 3600000)::BIGINT AS due_ms
    FROM pairs p JOIN s ON s.name = p.name, o WHERE next IS NULL OR next - coalesce(last, since) >= gap * 3600000"""
)
def stream_absent_schedules(given: Given) -> DataFrame:
    """Every time a schedule was not triggered within its gap, whatever came afterwards."""
    names = given.spark.createDataFrame(_SCHEDULES, "name string, max_gap_hours int")
    begin, end = [given.runs.agg(f("event_time")).scalar() for f in (F.min, F.max)]
    expected = names.select("name", begin.alias("event_time"), "max_gap_hours")
    runs = given.runs.select("name", "event_time", F.lit(None).cast("int").alias("max_gap_hours"))
    clock = given.spark.range(1).select(F.lit("clock").alias("name"), (end + F.make_dt_interval(F.lit(60))).alias("event_time"), F.lit(None).cast("int").alias("max_gap_hours"))
    return _fed(given, expected.unionByName(runs), lambda stream: alerts.absence_alarms(stream, "0 seconds"), clock)


@query(
    """WITH top AS (SELECT 'ns' || user_id % 2 AS namespace, 'db' || user_id % 3 AS job,
        floor(epoch(ts))::BIGINT // 600 * 600 AS s, max(value) AS top FROM events GROUP BY ALL),
    hit AS (SELECT *, s - row_number() OVER (PARTITION BY namespace, job ORDER BY s) * 600 AS island
      FROM top WHERE top > 20)
    SELECT namespace, job, min(s) AS start_s, max(s) AS end_s, count(*) AS steps FROM hit
    GROUP BY namespace, job, island HAVING max(s) - min(s) >= 1200"""
)
def stream_held_breaches(given: Given) -> DataFrame:
    """Breaches that held, as a stream: equal to the batch rule once time has passed."""
    of = lambda prefix, n: F.concat(F.lit(prefix), (F.col("user_id") % n).cast("string"))
    gauges = given.events.select(of("ns", 2).alias("namespace"), of("db", 3).alias("job"), "value", F.col("ts").alias("event_time"))
    end = gauges.agg(F.max("event_time")).scalar() + F.make_dt_interval(F.lit(60))
    clock = given.spark.range(1).select(F.lit("clock").alias("namespace"), F.lit("clock").alias("job"), F.lit(0.0).alias("value"), end.alias("event_time"))
    return _fed(given, gauges, lambda stream: alerts.held_breaches(stream, 600, 1200, 20.0, "0 seconds"), clock)
