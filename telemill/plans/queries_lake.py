"""Queries on table writes, joins, aggregates, rules, upkeep and the composed jobs."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemill import contract
from telemill.functions.jdl import decode_jdl
from telemill.operators import probes, quality, retention, rules, timeline
from telemill.operators.keys import latest_per_key, with_lineage
from telemill.plans import jobs, lake
from telemill.plans.domain import SQL, Given, ctes, decoded_sql
from telemill.plans.export import write_counted
from telemill.plans.lake import Lake
from telemill.plans.queries_scan import PER_FILE, dump_contents
from telemill.plans.registry import query
from telemill.session import scratch
from telemill.sources import cursors, dumps
from telemill.streaming import ingest

CUTOFF = datetime(1998, 3, 1)
NOW_1998 = CUTOFF + timedelta(days=quality.RETENTION_DAYS)
WIDTH = 100_000


def new_lake(given: Given, name: str) -> Lake:
    return Lake(given.spark, scratch(given.spark, name), width=WIDTH)


# ---- flagship ----------------------------------------------------------------------------


@query(
    "WITH "
    + decoded_sql(SQL["mon_jdls"])
    + """, wide AS (SELECT o.job_id, o.doc, w.pass, w.cores FROM obj o LEFT JOIN (
      SELECT job_id, max(v) FILTER (k = 'LPMPassName') AS pass, max(v) FILTER (k = 'CPUCores') AS cores
      FROM pairs GROUP BY job_id) w ON w.job_id = o.job_id)
    SELECT pass AS "LPMPassName", count(*) AS jobs, count(doc) AS parsed, sum(cores::BIGINT)::BIGINT AS cores
    FROM wide GROUP BY pass"""
)
def pass_summary(given: Given) -> DataFrame:
    """The contract view of decoded JDLs, aggregated by a contract column."""
    parsed = jobs.parsed_table(decode_jdl(given.mon_jdls), jobs._served_keys(), "load-1")
    view = contract.project(parsed, contract.MON_JDLS_PARSED)
    return view.groupBy("LPMPassName").agg(
        F.count("*").alias("jobs"),
        F.count_if("jdl_parse_ok").alias("parsed"),
        F.sum(F.col("CPUCores").cast("bigint")).alias("cores"),
    )


# ---- table writes ------------------------------------------------------------------------

_MERGED_SQL = f"""
SELECT job_id, CASE WHEN last_update >= TIMESTAMP '1998-01-01' THEN status ELSE 'OLD' END AS status,
  last_update, site FROM ({SQL['job_info']})"""


def _merged(given: Given) -> Lake:
    """An old version with stale statuses, then a merge of newer rows that overlaps it."""
    store, rows = new_lake(given, "merge"), given.job_info.select("job_id", "status", "last_update", "site")
    first = rows.filter("last_update < TIMESTAMP_NTZ '1999-01-01'").withColumn("status", F.lit("OLD"))
    store.upsert("job_info", first)
    fresh = cursors.since(rows, "last_update", "naive", "1998-01-01")
    store.upsert("job_info", fresh, cursor=("last_update", "naive"), run_id="second")
    return store


@query(_MERGED_SQL)
def upsert_merge(given: Given) -> DataFrame:
    return _merged(given).read("job_info")


@query(
    f"SELECT job_id, 'OLD' AS status, last_update, site FROM ({SQL['job_info']}) "
    "WHERE last_update < TIMESTAMP '1999-01-01'"
)
def time_travel(given: Given) -> DataFrame:
    """The version before the merge."""
    store = _merged(given)
    first = store.commits().filter("sequence_number = 1").select("snapshot_id").collect()[0][0]
    return store.read("job_info", snapshot_id=first)


@query(
    f"""SELECT 'job_info' AS resource, 'naive' AS cursor_kind,
    strftime(max(last_update), '%Y-%m-%dT%H:%M:%S') AS cursor_value, 'second' AS run_id FROM ({SQL['job_info']})"""
)
def saved_cursor(given: Given) -> DataFrame:
    return _merged(given).state().drop("updated_at")


@query(f"SELECT 'same' AS verdict, count(*) AS keys FROM ({SQL['job_info']})")
def replayed_merge(given: Given) -> DataFrame:
    """Merging the same rows again leaves every row identical."""
    store, rows = new_lake(given, "replay"), given.job_info
    store.upsert("job_info", rows)
    before = store.read("job_info")
    store.upsert("job_info", cursors.since(rows, "last_update", "naive", "1997-01-01"))
    return quality.reconcile(before, store.read("job_info"), "job_id", rows.columns)


_EVOLVED_SQL = f"""SELECT job_id, status, CASE WHEN job_id % 2 = 0 THEN site END AS site FROM ({SQL['job_info']})"""


@query(_EVOLVED_SQL)
def schema_evolution(given: Given) -> DataFrame:
    """A later load brings a new column: older rows read it as NULL."""
    store, rows = new_lake(given, "evolve"), given.job_info
    store.upsert("job_info", rows.select("job_id", "status"))
    store.upsert("job_info", rows.filter("job_id % 2 = 0").select("job_id", "status", "site"))
    return store.read("job_info")


@query(
    """SELECT l_orderkey AS job_id, l_linenumber, l_partkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey) = 1"""
)
def one_row_per_key(given: Given) -> DataFrame:
    return latest_per_key(given.children, "job_id", "l_linenumber")


@query(f"SELECT hostname, last_updated, 2 * count(*) AS rows FROM ({SQL['probes']}) GROUP BY ALL")
def append_fenced(given: Given) -> DataFrame:
    """Two runs append the same rows; a repeat of the first run adds nothing."""
    store = new_lake(given, "append")
    for run in ("a", "b", "a"):
        store.append("site_sonar", given.probes, run_id=run)
    return store.read("site_sonar").groupBy("hostname", "last_updated").agg(F.count("*").alias("rows"))


@query(f"SELECT DISTINCT hostname, last_updated FROM ({SQL['probes']})")
def distinct_on_read(given: Given) -> DataFrame:
    doubled = given.probes.unionByName(given.probes)
    return probes.distinct_on_read(doubled).select("hostname", "last_updated")


@query(
    """SELECT l_orderkey AS job_id, l_linenumber, l_partkey, 'load-7' AS _dlt_load_id,
    sha256('load-7|{"job_id":' || l_orderkey || ',"l_linenumber":' || l_linenumber || ',"l_partkey":' || l_partkey || '}')
    AS _dlt_id FROM lineitem"""
)
def load_lineage(given: Given) -> DataFrame:
    return with_lineage(given.children, "load-7")


@query(
    f"""SELECT 'job_info' AS "table", count(*) AS row_count FROM ({SQL['job_info']})
    UNION ALL SELECT 'trace', count(*) FROM ({SQL['trace']})"""
)
def counted_export(given: Given) -> DataFrame:
    """Parquet export; the row counts come from the writes."""
    target = scratch(given.spark, "export")
    rows = [(name, write_counted(getattr(given, name), f"{target}/{name}")) for name in ("job_info", "trace")]
    return given.spark.createDataFrame(rows, "table string, row_count bigint")


@query("SELECT 1 AS tables_before, 1 AS cursors_before, 0 AS tables_after, 0 AS cursors_after FROM (SELECT count(*) FROM orders)")
def full_reset(given: Given) -> DataFrame:
    """Tables and cursors go together."""
    store = _merged(given)
    before = (store.tables().count(), store.state().count())
    store.reset(confirm=True)
    after = (store.tables().count(), store.state().count())
    kind = "tables_before int, cursors_before int, tables_after int, cursors_after int"
    return given.spark.createDataFrame([before + after], kind)


# ---- commit log ------------------------------------------------------------------------------


@query(f'SELECT DISTINCT "table" FROM ({SQL["commits"]})')
def table_names(given: Given) -> DataFrame:
    return given.commits.select("table").distinct().orderBy("table")


@query(f'SELECT "table", arg_max(snapshot_id, sequence_number) AS snapshot_id FROM ({SQL["commits"]}) GROUP BY 1')
def latest_version(given: Given) -> DataFrame:
    return lake.latest_version(given.commits)


@query(
    f"""SELECT "table", operation, count(*) AS versions, min(committed_at) AS first, max(committed_at) AS last
    FROM ({SQL['commits']}) GROUP BY ALL"""
)
def version_history(given: Given) -> DataFrame:
    at = F.col("committed_at").cast("timestamp_ntz")
    return given.commits.groupBy("table", "operation").agg(
        F.count("*").alias("versions"), F.min(at).alias("first"), F.max(at).alias("last")
    )


_LOG_CUTOFF = datetime(2024, 1, 20, tzinfo=timezone.utc)


@query(
    ctes("commits")
    + """, heads AS (SELECT "table", max(sequence_number) AS head,
      max(sequence_number) FILTER (cursor_value IS NOT NULL) AS saved FROM commits GROUP BY 1),
    gone AS (SELECT c."table", count(*) AS n FROM commits c JOIN heads h ON h."table" = c."table"
      WHERE committed_at < TIMESTAMP '2024-01-20' AND sequence_number <> head
        AND sequence_number <> coalesce(saved, -1) GROUP BY 1)
    SELECT c."table", count(*) AS versions_before, count(*) - coalesce(any_value(n), 0) AS versions_after,
      coalesce(any_value(n), 0) AS expired
    FROM commits c LEFT JOIN gone g ON g."table" = c."table" GROUP BY 1"""
)
def expired_versions(given: Given) -> DataFrame:
    return lake.expired_versions(given.commits, _LOG_CUTOFF)


_FRESH_NOW = datetime(2024, 1, 31, 1, 40, tzinfo=timezone.utc)
_FRESH_SQL = (
    ctes("commits")
    + """, expected("table") AS (VALUES ('job_info'), ('trace'), ('mon_jdls_parsed'), ('never_written')),
    last AS (SELECT "table", max(committed_at) AS t FROM commits WHERE operation <> 'replace' GROUP BY 1)
    SELECT e."table", epoch_us(t) // 1000000 AS last_data_s,
      (epoch_us(TIMESTAMP '2024-01-31 01:40:00') - epoch_us(t)) // 1000000 AS age_s,
      coalesce(epoch_us(TIMESTAMP '2024-01-31 01:40:00') - epoch_us(t) > 26 * 3600 * 1000000::BIGINT, true) AS stale
    FROM expected e LEFT JOIN last l ON l."table" = e."table\""""
)


@query(_FRESH_SQL)
def freshness(given: Given) -> DataFrame:
    """Compaction commits do not make a table fresh; an unknown table is stale."""
    names = [(name,) for name in (*quality.CORE_TABLES, "never_written")]
    expected = given.spark.createDataFrame(names, "table string")
    return quality.freshness(given.commits, expected, F.lit(_FRESH_NOW))


@query(
    ctes("commits")
    + """, d AS (SELECT "table", count(*) AS b, count(*) FILTER (operation <> 'replace') AS a FROM commits GROUP BY 1)
    SELECT "table", b AS before, a AS after, b - a AS removed FROM d
    UNION ALL SELECT 'total', sum(b)::BIGINT, sum(a)::BIGINT, sum(b - a)::BIGINT FROM d"""
)
def upkeep_delta(given: Given) -> DataFrame:
    before = given.commits.groupBy("table").agg(F.count("*").alias("versions"))
    after = given.commits.filter("operation <> 'replace'").groupBy("table").agg(F.count("*").alias("versions"))
    return quality.upkeep_delta(before, after, "versions")


@query(
    ctes("commits")
    + """SELECT "table", 'data/' || "table" || '/' || sequence_number // 10 AS folder,
      sequence_number || '.parquet' AS path FROM commits
    WHERE committed_at < TIMESTAMP '2024-01-20' AND sequence_number // 10 % 3 = 0"""
)
def orphan_files(given: Given) -> DataFrame:
    """Stored files whose folder no version references."""
    folder = F.concat(F.lit("data/"), "table", F.lit("/"), F.expr("sequence_number div 10"))
    stored = given.commits.select(
        "table", folder.alias("folder"), F.concat("sequence_number", F.lit(".parquet")).alias("path"),
        F.col("committed_at").alias("modified_at"),
    )
    referenced = (
        given.commits.filter("sequence_number div 10 % 3 <> 0")
        .select("table", folder.alias("path")).distinct()
    )
    return lake.orphan_files(stored, referenced, _LOG_CUTOFF).drop("modified_at")


# ---- retention --------------------------------------------------------------------------------

_OLD_JDLS = """
SELECT DISTINCT m.job_id FROM children m LEFT JOIN parents j ON j.job_id = m.job_id
WHERE j.last_update < TIMESTAMP '1998-03-01'
  OR (j.job_id IS NULL AND m.job_id < (SELECT coalesce(min(job_id), 0) FROM parents))"""


@query(ctes("children", "parents") + _OLD_JDLS)
def old_or_orphaned(given: Given) -> DataFrame:
    return retention.old_jdls(given.children, given.parents, CUTOFF)


@query(
    ctes("job_info", "lake_keys")
    + """SELECT job_id, job_id IN (SELECT job_id FROM lake_keys) AS verified FROM job_info
    WHERE last_update < TIMESTAMP '1998-03-01'"""
)
def presence_check(given: Given) -> DataFrame:
    return retention.presence(retention.old_jobs(given.job_info, CUTOFF), given.lake_keys)


_REVIVED = "CASE WHEN job_id % 13 = 0 THEN last_update + INTERVAL 4000 DAY ELSE last_update END"


def _revived(given: Given) -> DataFrame:
    later = F.col("last_update") + F.make_dt_interval(F.lit(4000))
    moved = F.when(F.col("job_id") % 13 == 0, later).otherwise(F.col("last_update"))
    return given.parents.withColumn("last_update", moved)


@query(
    ctes("children", "parents", "lake_keys")
    + f""", candidates AS ({_OLD_JDLS}), verified AS (SELECT job_id FROM candidates SEMI JOIN lake_keys USING (job_id)),
    now_parents AS (SELECT * REPLACE ({_REVIVED} AS last_update) FROM parents)
    SELECT DISTINCT job_id FROM children WHERE job_id IN (SELECT job_id FROM verified) AND (
      job_id IN (SELECT job_id FROM now_parents WHERE last_update < TIMESTAMP '1998-03-01')
      OR (job_id NOT IN (SELECT job_id FROM now_parents)
          AND job_id < (SELECT coalesce(min(job_id), 0) FROM now_parents)))"""
)
def recheck_at_delete(given: Given) -> DataFrame:
    """Some parents revive between the choice and the delete: their rows stay."""
    candidates = retention.old_jdls(given.children, given.parents, CUTOFF)
    verified = retention.presence(candidates, given.lake_keys).filter("verified").select("job_id")
    return retention.deletable_jdls(given.children, _revived(given), verified, CUTOFF)


@query(
    ctes("job_info", "lake_keys")
    + """SELECT job_id, status, last_update FROM job_info
    WHERE NOT (last_update < TIMESTAMP '1998-03-01' AND job_id IN (SELECT job_id FROM lake_keys))"""
)
def verified_delete(given: Given) -> DataFrame:
    """What is left after old, verified rows were removed from a stored table."""
    store = new_lake(given, "delete")
    store.upsert("job_info", given.job_info)
    checked = retention.presence(retention.old_jobs(given.job_info, CUTOFF), given.lake_keys)
    verified = checked.filter("verified").select("job_id")
    store.delete("job_info", retention.deletable_jobs(store.read("job_info"), verified, CUTOFF))
    return store.read("job_info").select("job_id", "status", "last_update")


_PLAUSIBLE_SQL = ctes("trace") + """
SELECT min(laststatuschangetimestamp) AS lo_ms, max(laststatuschangetimestamp) AS hi_ms,
  coalesce(to_timestamp(min(laststatuschangetimestamp) / 1000.0) >= TIMESTAMPTZ '{0}'
    AND to_timestamp(max(laststatuschangetimestamp) / 1000.0) < TIMESTAMPTZ '{1}', true) AS plausible
FROM trace WHERE laststatuschangetimestamp < 888710400000"""


@query(_PLAUSIBLE_SQL.format("2020-01-01 00:00:00+00", "2035-01-01 00:00:00+00"))
def implausible_times(given: Given) -> DataFrame:
    """The given times lie before the default window: a pass over them must abort."""
    return retention.plausibility(given.trace, retention.old_traces(given.trace, CUTOFF))


@query(_PLAUSIBLE_SQL.format("1990-01-01 00:00:00+00", "2005-01-01 00:00:00+00"))
def plausible_times(given: Given) -> DataFrame:
    window = (datetime(1990, 1, 1), datetime(2005, 1, 1))
    return retention.plausibility(given.trace, retention.old_traces(given.trace, CUTOFF), window)


_OUTCOME_SQL = (
    ctes("job_info", "trace", "children", "parents", "lake_keys")
    + f""", old(name, job_id) AS (
      SELECT 'job_info', job_id FROM job_info WHERE last_update < TIMESTAMP '1998-03-01'
      UNION ALL SELECT 'trace', job_id FROM trace WHERE laststatuschangetimestamp < 888710400000
      UNION ALL SELECT 'mon_jdls', job_id FROM ({_OLD_JDLS})),
    marked AS (SELECT name, job_id, job_id IN (SELECT job_id FROM lake_keys) AS v FROM old),
    landing(name, job_id) AS (SELECT 'job_info', job_id FROM job_info UNION ALL SELECT 'trace', job_id FROM trace
      UNION ALL SELECT 'mon_jdls', job_id FROM children),
    removed AS (SELECT l.name, count(*) AS deleted FROM landing l
      SEMI JOIN (SELECT * FROM marked WHERE v) m ON m.name = l.name AND m.job_id = l.job_id GROUP BY 1),
    per AS (SELECT m.name, count(*) FILTER (NOT v) AS missing, any_value(r.deleted) AS deleted
      FROM marked m JOIN removed r ON r.name = m.name GROUP BY 1)
    SELECT name AS "table", missing AS kept, deleted, missing AS unverified, (missing > 0)::INTEGER AS exit_code FROM per
    UNION ALL SELECT 'total', sum(missing)::BIGINT, sum(deleted)::BIGINT, sum(missing)::BIGINT,
      (sum(missing) > 0)::INTEGER FROM per"""
)


@query(_OUTCOME_SQL)
def retention_rollup(given: Given) -> DataFrame:
    """Kept, deleted and unverified per landing table, plus the total."""
    candidates = {
        "job_info": (given.job_info, retention.old_jobs(given.job_info, CUTOFF)),
        "trace": (given.trace, retention.old_traces(given.trace, CUTOFF)),
        "mon_jdls": (given.children, retention.old_jdls(given.children, given.parents, CUTOFF)),
    }
    outcomes = None
    for name, (rows, old) in candidates.items():
        checked = retention.presence(old, given.lake_keys)
        deleted = rows.join(checked.filter("verified"), "job_id", "left_semi")
        part = retention.outcome(name, checked, deleted)
        outcomes = part if outcomes is None else outcomes.unionByName(part)
    return retention.rollup(outcomes)


@query(
    ctes("job_info", "lake_keys")
    + """SELECT job_id FROM job_info WHERE last_update < TIMESTAMP '1998-03-01'
    AND job_id NOT IN (SELECT job_id FROM lake_keys) ORDER BY job_id LIMIT 20"""
)
def audit_sample(given: Given) -> DataFrame:
    """The first 20 unverified keys: the report the pass prints."""
    return retention.audit_sample(
        retention.presence(retention.old_jobs(given.job_info, CUTOFF), given.lake_keys)
    )


# ---- joins and comparisons ----------------------------------------------------------------------

_ASOF_SQL = ctes("starts", "probes") + """
SELECT s.job_id, s.host, s.startedtimestamp, p.last_updated, p.probe_id
FROM starts s ASOF LEFT JOIN (
  SELECT hostname, last_updated, max(probe_id) AS probe_id FROM probes GROUP BY ALL) p
ON s.host = p.hostname AND s.startedtimestamp > p.last_updated * 1000"""


@query(_ASOF_SQL)
def probe_at_start(given: Given) -> DataFrame:
    """Each job start with its host's newest probe strictly before it."""
    return probes.host_at_start(given.starts, given.probes, ["probe_id"])


_CHANGED = "SELECT * REPLACE (CASE WHEN job_id % 10 = 0 THEN 'X' ELSE status END AS status) FROM job_info"


@query(
    ctes("job_info")
    + f""", l AS (SELECT * FROM job_info WHERE job_id % 6 <> 0), r AS (SELECT * FROM ({_CHANGED}) WHERE job_id % 7 <> 0)
    SELECT CASE WHEN r.job_id IS NULL THEN 'missing' WHEN l.job_id IS NULL THEN 'extra'
      WHEN l.status = r.status THEN 'same' ELSE 'changed' END AS verdict, count(*) AS keys
    FROM l FULL JOIN r ON r.job_id = l.job_id GROUP BY 1"""
)
def reconcile(given: Given) -> DataFrame:
    rows = given.job_info
    other = rows.withColumn("status", F.when(F.col("job_id") % 10 == 0, "X").otherwise(F.col("status")))
    return quality.reconcile(
        rows.filter("job_id % 6 <> 0"), other.filter("job_id % 7 <> 0"), "job_id", rows.columns
    )


@query(
    ctes("job_info", "trace", "children")
    + " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS rows, count(DISTINCT job_id) AS keys, "
        f"count(*) - count(DISTINCT job_id) AS duplicates FROM {t}"
        for t in ("job_info", "trace", "children")
    )
)
def table_counts(given: Given) -> DataFrame:
    return quality.table_counts({"job_info": given.job_info, "trace": given.trace, "children": given.children})


# ---- rules --------------------------------------------------------------------------------------


def _failed_steps(given: Given, step_s: int) -> DataFrame:
    return rules.step_counts(given.runs, step_s, F.col("phase").isin(*rules.FAILED))


def _increase_sql(step_s: int, span_s: int, least: int) -> str:
    return (
        ctes("runs")
        + f""", counted AS (SELECT name, floor(epoch(event_time))::BIGINT // {step_s} * {step_s} AS s, count(*) AS n
          FROM runs WHERE phase IN ('Failed', 'Error') GROUP BY ALL),
        spread AS (SELECT name, s + unnest(range({step_s}, {span_s + step_s}, {step_s})) AS e, n FROM counted)
        SELECT name, make_timestamp(e::BIGINT * 1000000) AS "at", sum(n)::BIGINT AS increase,
          sum(n) >= {least} AS breached FROM spread GROUP BY name, e"""
    )


@query(_increase_sql(300, 3600, 1))
def failures_last_hour(given: Given) -> DataFrame:
    return rules.increase_over(_failed_steps(given, 300), 3600, 300, 1)


@query(_increase_sql(3600, 7 * 86400, 3))
def failures_last_week(given: Given) -> DataFrame:
    return rules.increase_over(_failed_steps(given, 3600), 7 * 86_400, 3600, 3)


@query(
    """WITH c AS (SELECT user_id AS series, floor(epoch(ts))::BIGINT AS s, event_id % 50 AS total FROM events),
    l AS (SELECT *, lag(total) OVER (PARTITION BY series ORDER BY s, total) AS p FROM c)
    SELECT series, s AS "at", total, CASE WHEN p IS NULL THEN NULL WHEN total >= p THEN total - p ELSE total END AS increase
    FROM l"""
)
def counter_increase(given: Given) -> DataFrame:
    samples = given.events.select(
        F.col("user_id").alias("series"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("at"),
        (F.col("event_id") % 50).alias("total"),
    )
    return timeline.counter_increase(samples, "series", "at", "total", 86_400)


@query(
    ctes("runs")
    + """, s(name, max_gap_hours) AS (VALUES ('flow_0', 26), ('flow_1', 1), ('flow_2', 192), ('flow_9', 26)),
    last AS (SELECT name, max(event_time) AS last_run FROM runs GROUP BY 1)
    SELECT s.name, s.max_gap_hours, last_run,
      last_run IS NULL OR epoch(TIMESTAMP '2024-01-31 01:00:00') - floor(epoch(last_run)) >= max_gap_hours * 3600 AS absent
    FROM s LEFT JOIN last ON last.name = s.name"""
)
def absent_schedules(given: Given) -> DataFrame:
    expected = given.spark.createDataFrame(
        [("flow_0", 26), ("flow_1", 1), ("flow_2", 192), ("flow_9", 26)], "name string, max_gap_hours int"
    )
    now = F.lit(datetime(2024, 1, 31, 1, 0, tzinfo=timezone.utc))
    return rules.absent(expected, given.runs, now)


@query(
    """WITH top AS (SELECT 'ns' || user_id % 2 AS namespace, 'db' || user_id % 3 AS job,
        floor(epoch(ts))::BIGINT // 600 * 600 AS s, max(value) AS top FROM events GROUP BY ALL),
    hit AS (SELECT *, s - row_number() OVER (PARTITION BY namespace, job ORDER BY s) * 600 AS island
      FROM top WHERE top > 20)
    SELECT namespace, job, min(s) AS start_s, max(s) AS end_s, count(*) AS steps FROM hit
    GROUP BY namespace, job, island HAVING max(s) - min(s) >= 1200"""
)
def gauge_breaches(given: Given) -> DataFrame:
    gauges = given.events.select(
        F.concat(F.lit("ns"), (F.col("user_id") % 2).cast("string")).alias("namespace"),
        F.concat(F.lit("db"), (F.col("user_id") % 3).cast("string")).alias("job"),
        "value",
        F.col("ts").alias("event_time"),
    )
    return rules.gauge_breaches(gauges, 600, 1200, F.col("top") > 20)


@query(f"SELECT * FROM ({SQL['probes']}) WHERE last_updated >= 1705000000")
def late_probes_dropped(given: Given) -> DataFrame:
    return probes.not_late(given.probes, 1_705_000_000)


# ---- upkeep ---------------------------------------------------------------------------------------


def _loose(given: Given) -> Lake:
    """A table of several small appends."""
    store, rows = new_lake(given, "loose"), given.probes
    for part in range(3):
        store.append("site_sonar", rows.filter(F.col("probe_id") % 3 == part), run_id=f"r{part}")
    return store


@query(f"SELECT * FROM ({SQL['probes']})")
def compaction(given: Given) -> DataFrame:
    """The same rows after small files were rewritten."""
    store = _loose(given)
    store.compact("site_sonar")
    return store.read("site_sonar")


@query(
    f"""SELECT n AS sequence_number, CASE WHEN n = 4 THEN 'replace' ELSE 'append' END AS operation,
    (SELECT count(*) FROM ({SQL['probes']}) WHERE n = 4 OR probe_id % 3 < n) AS total_records
    FROM range(1, 5) t(n)"""
)
def compaction_log(given: Given) -> DataFrame:
    """Compaction adds a ``replace`` version with the same number of records."""
    store = _loose(given)
    store.compact("site_sonar")
    return store.commits().select("sequence_number", "operation", "total_records")


@query(
    f"SELECT 'site_sonar' AS \"table\", count(*) AS rows, 1::BIGINT AS versions FROM ({SQL['probes']})"
)
def upkeep_sequence(given: Given) -> DataFrame:
    """Compact, expire, remove orphans a month later: one version, all rows."""
    store = _loose(given)
    later = datetime.now(timezone.utc) + timedelta(days=30)
    jobs.run_upkeep(store, later)
    versions = store.commits().groupBy("table").agg(F.count("*").alias("versions"))
    rows = store.read("site_sonar").agg(F.count("*")).scalar()
    return versions.select("table", rows.alias("rows"), "versions")


# ---- composed jobs ----------------------------------------------------------------------------------


def _landing(given: Given) -> dict[str, DataFrame]:
    return {"job_info": given.job_info, "trace": given.trace, "mon_jdls": given.mon_jdls}


def _nightly(given: Given) -> Lake:
    store = new_lake(given, "nightly")
    starts = {"job_info": "1996-01-01", "trace": "820454400000", "mon_jdls": "100"}
    jobs.run_nightly(store, _landing(given), "night-1", starts)
    return store


_NIGHTLY_SQL = (
    ctes("job_info", "trace", "mon_jdls")
    + """SELECT 'job_info' AS "table", '1996-01-01T00:00:00' AS from_cursor,
      strftime(max(last_update), '%Y-%m-%dT%H:%M:%S') AS to_cursor, 0 AS exit_code FROM job_info
    UNION ALL SELECT 'trace', '820454400000', max(laststatuschangetimestamp)::VARCHAR, 0 FROM trace
    UNION ALL SELECT 'mon_jdls_parsed', '100', max(job_id)::VARCHAR, 0 FROM mon_jdls"""
)


@query(_NIGHTLY_SQL)
def backfill_start(given: Given) -> DataFrame:
    """First run with start overrides: cursors read from and saved."""
    store = new_lake(given, "backfill")
    starts = {"job_info": "1996-01-01", "trace": "820454400000", "mon_jdls": "100"}
    return jobs.run_nightly(store, _landing(given), "night-1", starts).drop("snapshot_id")


@query(
    ctes("job_info", "trace", "mon_jdls")
    + """SELECT 'job_info' AS "table", count(*) AS rows, 1::BIGINT AS versions
      FROM job_info WHERE last_update >= TIMESTAMP '1996-01-01'
    UNION ALL SELECT 'trace', count(*), 1 FROM trace WHERE laststatuschangetimestamp >= 820454400000
    UNION ALL SELECT 'mon_jdls_parsed', count(*), 1 FROM mon_jdls WHERE job_id >= 100"""
)
def nightly_job(given: Given) -> DataFrame:
    store = _nightly(given)
    log = store.commits().groupBy("table").agg(F.count("*").alias("versions"))
    names = ("job_info", "trace", "mon_jdls_parsed")
    counts = quality.table_counts({name: store.read(name) for name in names})
    return counts.join(F.broadcast(log), "table").select("table", "rows", "versions")


@query(
    ctes("children", "job_info", "trace", "lake_keys")
    + """, old(name, job_id) AS (
      SELECT 'job_info', job_id FROM job_info WHERE last_update < TIMESTAMP '1998-03-01'
      UNION ALL SELECT 'trace', job_id FROM trace WHERE laststatuschangetimestamp < 888710400000
      UNION ALL SELECT 'mon_jdls', job_id FROM (SELECT DISTINCT c.job_id FROM children c JOIN job_info j
        ON j.job_id = c.job_id WHERE j.last_update < TIMESTAMP '1998-03-01'))
    SELECT 'abort' AS "table", 0::BIGINT AS kept, 0::BIGINT AS deleted, 0::BIGINT AS unverified, 1 AS exit_code
    FROM (SELECT count(*) AS n FROM old WHERE name = 'trace') WHERE n > 0"""
)
def retention_abort(given: Given) -> DataFrame:
    """Trace times outside the plausible window stop the pass before any delete."""
    landing, store = new_lake(given, "landing"), new_lake(given, "held")
    for name, rows in (("job_info", given.job_info), ("trace", given.trace)):
        landing.upsert(name, rows)
        store.upsert(name, given.lake_keys)
    landing.append("mon_jdls", given.children)
    store.upsert("mon_jdls_parsed", given.lake_keys)
    return jobs.run_retention(landing, store, NOW_1998)


_SHIFT = 9_862  # days from the given dates into the plausible window


@query(
    ctes("children", "job_info", "trace", "lake_keys")
    + """, cut AS (SELECT TIMESTAMP '1998-03-01' AS t),
    per(name, missing, deleted) AS (
      SELECT 'job_info', count(*) FILTER (NOT v), count(*) FILTER (v) FROM (
        SELECT job_id IN (SELECT job_id FROM lake_keys) AS v FROM job_info, cut WHERE last_update < t)
      UNION ALL
      SELECT 'trace', count(*) FILTER (NOT v), count(*) FILTER (v) FROM (
        SELECT job_id IN (SELECT job_id FROM lake_keys) AS v FROM trace, cut
        WHERE laststatuschangetimestamp < epoch_ms(t))
      UNION ALL
      SELECT 'mon_jdls', count(DISTINCT job_id) FILTER (NOT v), count(*) FILTER (v) FROM (
        SELECT c.job_id, c.job_id IN (SELECT job_id FROM lake_keys) AS v
        FROM children c JOIN job_info j ON j.job_id = c.job_id, cut WHERE j.last_update < t))
    SELECT name AS "table", missing AS kept, deleted, missing AS unverified, (missing > 0)::INTEGER AS exit_code FROM per
    UNION ALL SELECT 'total', sum(missing)::BIGINT, sum(deleted)::BIGINT, sum(missing)::BIGINT, 1 FROM per"""
)
def retention_job(given: Given) -> DataFrame:
    """The whole pass over stored tables, with the given dates moved into the plausible window."""
    landing, store = new_lake(given, "landing"), new_lake(given, "held")
    moved = given.job_info.withColumn(
        "last_update", F.col("last_update") + F.make_dt_interval(F.lit(_SHIFT))
    )
    shifted = given.trace.withColumn(
        "laststatuschangetimestamp", F.col("laststatuschangetimestamp") + F.lit(_SHIFT * 86_400_000)
    )
    landing.upsert("job_info", moved)
    landing.upsert("trace", shifted)
    landing.append("mon_jdls", given.children)
    for name in ("job_info", "trace", "mon_jdls_parsed"):
        store.upsert(name, given.lake_keys)
    return jobs.run_retention(landing, store, NOW_1998 + timedelta(days=_SHIFT))


@query(
    "SELECT t AS \"table\", false AS stale, 0 AS exit_code FROM (VALUES ('job_info'), ('trace'), ('mon_jdls_parsed')) v(t)"
    " WHERE (SELECT count(*) FROM orders) > 0"
)
def freshness_job(given: Given) -> DataFrame:
    """The gate right after a nightly run."""
    checked = jobs.check_freshness(_nightly(given), datetime.now(timezone.utc))
    return checked.select("table", "stale", "exit_code")


@query(
    "WITH "
    + decoded_sql(SQL["mon_jdls"])
    + f""", unknown AS (SELECT DISTINCT k FROM pairs WHERE job_id >= 100 AND k NOT IN
      ({', '.join(f"'{k}'" for k in contract.JDL_KEYS if k not in contract.UNSERVED_KEYS)}))
    SELECT count(*) AS additive, 0::BIGINT AS informational, 0::BIGINT AS subtractive, true AS applied,
      CASE WHEN count(*) > 0 THEN 2 ELSE 0 END AS exit_code FROM unknown"""
)
def publish_job(given: Given) -> DataFrame:
    """Strict publication after a nightly run: views applied, new JDL keys reported."""
    served = {name: contract.TABLES[name] for name in ("job_info", "mon_jdls_parsed")}
    return jobs.publish_contract(_nightly(given), strict=True, tables=served)[0]


@query(
    f"""SELECT 0::BIGINT AS additive, 0::BIGINT AS informational,
    {len(contract.TRACE_NAMES)} - count(*) AS subtractive, false AS applied, 2 AS exit_code
    FROM (DESCRIBE SELECT * FROM ({SQL['trace']}))"""
)
def publish_blocked(given: Given) -> DataFrame:
    """A table without all contract columns: no view is applied, strict or not."""
    store = new_lake(given, "blocked")
    store.upsert("trace", given.trace)
    return jobs.publish_contract(store, tables={"trace": contract.TRACE})[0]


@query(
    ctes("job_info", "trace", "mon_jdls")
    + """SELECT 'job_info' AS "table", 'contract.job_info' AS source, 'contract' AS source_schema, count(*) AS row_count,
      'job_info.parquet' AS output_file, false AS fell_back FROM job_info WHERE last_update >= TIMESTAMP '1996-01-01'
    UNION ALL SELECT 'trace', 'lake.trace', 'lake', count(*), 'trace.parquet', true
      FROM trace WHERE laststatuschangetimestamp >= 820454400000
    UNION ALL SELECT 'mon_jdls_parsed', 'contract.mon_jdls_parsed', 'contract', count(*), 'mon_jdls_parsed.parquet', false
      FROM mon_jdls WHERE job_id >= 100"""
)
def export_job(given: Given) -> DataFrame:
    """Export with manifest; ``trace`` lacks contract columns here and falls back to the lake table."""
    target = scratch(given.spark, "out")
    frame = jobs.run_export(_nightly(given), target)
    return frame.select(
        "table", "source", "source_schema", "row_count", "output_file",
        F.col("fallback_reason").isNotNull().alias("fell_back"),
    )


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item in batch.to_pylist():
            store, place = fs.FileSystem.from_uri(item["target"])
            store.create_dir(place.rsplit("/", 1)[0])
            with store.open_output_stream(place) as out:
                out.write(item["content"])
        yield batch.select(["target"])


def stored_dumps(given: Given, folder: str, where: str = "true") -> DataFrame:
    """(epoch, url) of the events' dump files, written to shared storage by the executors."""
    root = folder if ":" in folder else f"file://{folder}"
    files = dump_contents(given).filter(where).select(F.concat(F.lit(f"{root}/"), "path").alias("target"), "content")
    files.mapInArrow(_store, "target string").count()
    return dumps.dump_files(given.spark, folder)


@query(
    f"""WITH f AS (SELECT DISTINCT event_id // {PER_FILE} AS f FROM events),
    first AS (SELECT max(last_s) AS row FROM (SELECT floor(epoch(ts))::BIGINT AS last_s FROM events
      WHERE event_id // {PER_FILE} < 5))
    SELECT user_id AS host_id, floor(epoch(ts))::BIGINT AS last_updated, event_type AS ce_name
    FROM events, first WHERE event_id // {PER_FILE} < 5 OR floor(epoch(ts))::BIGINT >= first.row"""
)
def dump_job(given: Given) -> DataFrame:
    """Two runs over stored files, the first over five: rows late for the second are left out."""
    store = new_lake(given, "dumps")
    files = stored_dumps(given, f"{store.root}/feed")
    jobs.run_dumps(store, files, "run-1", limit=5)
    jobs.run_dumps(store, files, "run-2")
    return store.read("site_sonar").select("host_id", "last_updated", "ce_name")


# ---- streams ------------------------------------------------------------------------------------------


def _event_stream(given: Given, files_per_batch: int = 1000) -> DataFrame:
    """The events table as a stream, be it one file or a folder of parts: a pattern may name either."""
    return ingest.file_stream(given.spark, f"{given.folder}/events.parque[t]", given.events.schema, files_per_batch)


@query(f"SELECT DISTINCT hostname, last_updated FROM ({SQL['probes']})")
def stream_distinct_probes(given: Given) -> DataFrame:
    """Duplicates dropped within the lateness bound, as a stream over all input; the bound is the table's own span."""
    target = scratch(given.spark, "stream")
    rows = _event_stream(given).filter("event_type = 'signup'").select(
        F.concat(F.lit("wn"), F.lpad((F.col("user_id") % 200 + 1).cast("string"), 4, "0")).alias("hostname"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("last_updated"),
    )
    lateness = ingest.whole_span(given.events, "ts")
    ingest.write_available(ingest.distinct_probes(rows, lateness), f"{target}/out", f"{target}/state")
    return given.spark.read.parquet(f"{target}/out").select("hostname", "last_updated")


@query(
    ctes("runs")
    + """, spread AS (SELECT name, (floor(epoch(event_time))::BIGINT // 3600 + unnest(range(1, 7))) * 3600 AS e
      FROM runs WHERE phase = 'Failed')
    SELECT name, make_timestamp(e::BIGINT * 1000000) AS "at", count(*) AS increase FROM spread GROUP BY name, e"""
)
def stream_failure_windows(given: Given) -> DataFrame:
    """Sliding failure counts as a stream; equal to the batch rule in whatever order the files come.

    The lateness is the table's own span, so no row of any file order is dropped; if one were, the query would fail.
    """
    target = scratch(given.spark, "stream")
    runs = _event_stream(given).select(
        F.concat(F.lit("flow_"), (F.col("user_id") % 3).cast("string")).alias("name"),
        F.when(F.col("event_type") == "error", "Failed").otherwise("Succeeded").alias("phase"),
        F.col("ts").alias("event_time"),
    )
    counted = ingest.failure_windows(runs, F.col("phase") == "Failed", "6 hours", "1 hour", ingest.whole_span(given.events, "ts"))

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/out/batch={batch_id}")

    writer = counted.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{target}/state")
    ingest.finish(given.spark, writer.trigger(availableNow=True).start)
    latest = given.spark.read.parquet(f"{target}/out").groupBy("name", "at").agg(
        F.max_by("increase", "batch").alias("increase")
    )
    return latest.select("name", F.col("at").cast("timestamp_ntz").alias("at"), "increase")


@query("SELECT event_id, user_id, event_type FROM events")
def stream_append(given: Given) -> DataFrame:
    """Micro-batches appended to a lake table, each once; run again, nothing is added."""
    store = new_lake(given, "stream")
    rows = _event_stream(given, 2).select("event_id", "user_id", "event_type")
    for _ in range(2):
        ingest.append_stream(store, rows, "events", "events", f"{store.root}/checkpoint").awaitTermination()
    return store.read("events")


@query(
    """SELECT event_id AS job_id, event_type AS status, ts AS last_update FROM events"""
)
def stream_upsert(given: Given) -> DataFrame:
    """Micro-batches merged into a lake table; run again, nothing changes."""
    store = new_lake(given, "stream")
    rows = _event_stream(given).select(
        F.col("event_id").alias("job_id"), F.col("event_type").alias("status"), F.col("ts").alias("last_update")
    )
    for _ in range(2):
        ingest.upsert_stream(
            store, rows, "job_info", "events", f"{store.root}/checkpoint", cursor=("last_update", "naive")
        ).awaitTermination()
    return store.read("job_info")


# ---- layouts: every write follows the key that the table was merged by -------------------------------

# Fixed value: ids of the landing tables begin here, far from the first key range.
FIRST_ID = 3_593_645_502
_SHIFTED = f"SELECT o_orderkey + {FIRST_ID} AS job_id, o_orderstatus AS status, o_totalprice AS price FROM orders"


def _shifted(given: Given) -> DataFrame:
    return given.orders.select(
        (F.col("o_orderkey") + FIRST_ID).alias("job_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"),
    )


def _changed(rows: DataFrame) -> DataFrame:
    return rows.filter("job_id % 7 = 0").withColumn("status", F.lit("changed"))


_CHANGED = f"""SELECT job_id, CASE WHEN job_id % 7 = 0 THEN 'changed' ELSE status END AS status, price FROM ({_SHIFTED})"""


@query(_CHANGED)
def merge_after_append(given: Given) -> DataFrame:
    """Three appends and then a merge: all rows stay, once each."""
    store, rows = new_lake(given, "appended"), _shifted(given)
    for part in range(3):
        store.append("t", rows.filter(F.pmod("job_id", F.lit(3)) == part))
    store.upsert("t", _changed(rows))
    return store.read("t")


@query(f"SELECT * FROM ({_SHIFTED}) WHERE job_id % 5 <> 0")
def delete_after_append(given: Given) -> DataFrame:
    """Rows leave a table of appends whatever their ids are."""
    store, rows = new_lake(given, "deleted"), _shifted(given)
    store.append("t", rows.filter("job_id % 2 = 0"))
    store.append("t", rows.filter("job_id % 2 = 1"))
    store.delete("t", rows.filter("job_id % 5 = 0"))
    return store.read("t")


@query(_CHANGED)
def merge_after_upkeep(given: Given) -> DataFrame:
    """Upkeep between two merges of a table keeps its layout, and so its keys unique."""
    store, rows = new_lake(given, "tended"), _shifted(given)
    store.upsert("t", rows.filter("job_id % 2 = 0"))
    store.upsert("t", rows.filter("job_id % 2 = 1"))
    jobs.run_upkeep(store, datetime(2100, 1, 1, tzinfo=timezone.utc))
    store.upsert("t", _changed(rows))
    return store.read("t")


@query(_SHIFTED)
def upkeep_nested_root(given: Given) -> DataFrame:
    """Upkeep of a lake whose root holds a segment named as its own data folder: nothing live goes."""
    store, rows = Lake(given.spark, scratch(given.spark, "nested") + "/data/lake"), _shifted(given)
    store.append("t", rows)
    jobs.run_upkeep(store, datetime(2100, 1, 1, tzinfo=timezone.utc))
    return store.read("t")


@query(
    """SELECT 'orders' AS "table", 3::BIGINT AS versions, count(*) AS records, true AS stored FROM orders
    UNION ALL SELECT 'events', 1, count(*), true FROM events"""
)
def lake_inventory(given: Given) -> DataFrame:
    """Names, version history and files as the lake itself reports them."""
    store = new_lake(given, "inventory")
    for part in range(3):
        store.append("orders", given.orders.filter(F.pmod("o_orderkey", F.lit(3)) == part))
    store.append("events", given.events)
    history = store.commits().groupBy("table").agg(
        F.count("*").alias("versions"), F.max_by("total_records", "sequence_number").alias("records")
    )
    files = store.current_files().select("table", (F.col("files") > 0).alias("stored"))
    return store.tables().join(history, "table").join(files, "table").select("table", "versions", "records", "stored")


@query(
    ctes("job_info")
    + "SELECT job_id, site, status FROM job_info"
)
def published_view(given: Given) -> DataFrame:
    """A contract view read by its published definition, after another version of its table."""
    store, rows = new_lake(given, "views"), given.job_info
    store.upsert("job_info", rows.filter("job_id % 2 = 0"))
    jobs.publish_contract(store, tables={"job_info": contract.JOB_INFO})
    store.upsert("job_info", rows)
    view = jobs.contract_view(store, "job_info")
    return view.select("job_id", "site", "status")
