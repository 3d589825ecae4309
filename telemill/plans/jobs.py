"""The scheduled jobs. Each returns a verdict frame; ``exit_code`` turns it into a code."""

from __future__ import annotations

import time
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from telemill import contract
from telemill.functions.jdl import OTHER, decode_jdl, flatten_jdl, flatten_served, spellings
from telemill.functions.names import PREFIX
from telemill.operators import retention
from telemill.operators.drift import contract_rows, drift, drift_verdict, schema_rows
from telemill.operators.keys import latest_per_key, with_lineage
from telemill.operators.probes import not_late
from telemill.operators.quality import (
    CORE_TABLES,
    MAX_AGE_HOURS,
    RETENTION_DAYS,
    VERSION_DAYS,
    freshness,
    key_census,
    upkeep_delta,
)
from telemill.plans import export
from telemill.plans.lake import Lake, expired_versions, latest_version
from telemill.session import observed
from telemill.sources import dumps
from telemill.sources.cursors import CURSORS, since, start_value


@dataclass(frozen=True)
class Served:
    """Lake tables that landing table rows end up in."""

    landing: str
    lake: str


SERVED = (Served("job_info", "job_info"), Served("trace", "trace"), Served("mon_jdls", "mon_jdls_parsed"))


def exit_code(verdict: DataFrame) -> int:
    """The largest code any row reports: 0 ok, 1 failed check, 2 drift."""
    return verdict.agg(F.coalesce(F.max("exit_code"), F.lit(0))).collect()[0][0]


KEYS = "jdl_keys"

# ---- nightly ------------------------------------------------------------------------


def parsed_table(decoded: DataFrame, keys: Iterable[str], load_id: str, other: bool = False) -> DataFrame:
    """The lake row of ``mon_jdls``: bookkeeping columns first, then ``jdl__*`` columns, with ``other`` then all other keys in a map."""
    base = decoded.withColumn("full_jdl", F.lit(None).cast("string"))
    flat = flatten_served(base, keys) if other else flatten_jdl(base, keys)
    lineage = with_lineage(flat, load_id, "job_id")
    jdl = sorted(spellings(keys))
    head = ["job_id", "lpmjobtypeid", "full_jdl", "jdl_parse_ok", "full_jdl_raw"]
    return lineage.select(*head, "_dlt_load_id", "_dlt_id", *jdl, *([OTHER] if other else []))


def _served_keys() -> list[str]:
    named = [key for key in contract.JDL_KEYS if key not in contract.UNSERVED_KEYS]
    return named + list(contract.EXTRA_JDL)


def run_nightly(
    lake: Lake,
    landing: Mapping[str, DataFrame],
    run_id: str,
    starts: Mapping[str, str] | None = None,
    evolve: bool = True,
    promoted: Iterable[str] = (),
) -> DataFrame:
    """Incremental scan and merge of the three landing tables, one commit each, in order.

    With ``evolve`` every JDL key becomes a column, and the driver learns their names. Without it, for feeds whose
    keys have no bound, keys of the contract, those in ``promoted`` and those that have a column already are
    columns; all others go to one map column, and the census of a run's keys is appended to the table ``jdl_keys``.
    """
    starts = starts or {}
    rows = []
    for served in SERVED:
        cursor = CURSORS[served.landing]
        start = start_value(cursor, lake.cursor(served.lake), starts.get(served.landing))
        fresh = since(landing[served.landing], cursor.column, cursor.kind, start)
        census, blank = None, []
        if served.landing == "mon_jdls":
            fresh, census, blank = _staged_jdls(lake, fresh, run_id, evolve, promoted)
        version = lake.upsert(
            served.lake,
            fresh,
            cursor=(cursor.column, cursor.kind),
            run_id=run_id,
            unique=served.landing == "mon_jdls",
            blank=blank,
        )
        if census is not None and version is not None:
            lake.append(KEYS, census, run_id=run_id)
        rows.append((served.lake, start, lake.cursor(served.lake), version, 0))
    return lake.spark.createDataFrame(
        rows, "table string, from_cursor string, to_cursor string, snapshot_id bigint, exit_code int"
    )


def _staged_jdls(
    lake: Lake, fresh: DataFrame, run_id: str, evolve: bool, promoted: Iterable[str]
) -> tuple[DataFrame, DataFrame | None, list[str]]:
    """Decode once into a written table, so that the merge and the key census share the work.

    Returns the rows, the census to keep, and the columns of keys that the census met in no row.
    """
    one_per_job = latest_per_key(fresh, "job_id")
    folder = f"{lake.root}/data/decoded/{run_id}"
    decode_jdl(one_per_job).write.mode("overwrite").parquet(folder)
    decoded = lake.spark.read.parquet(folder)
    live = lake.read("mon_jdls_parsed").columns if lake.exists("mon_jdls_parsed") else []
    keys = [*_served_keys(), *promoted, *[name.removeprefix(PREFIX) for name in live if name.startswith(PREFIX)]]
    census = key_census(decoded)
    if evolve:
        found = sorted(row.key for row in census.select("key").toLocalIterator())
        blank = [name for name, group in spellings(found + keys).items() if not set(group) & set(found)]
        return parsed_table(decoded, found + keys, run_id, other=OTHER in live), None, blank
    return parsed_table(decoded, keys, run_id, other=True), census.withColumn("load_id", F.lit(run_id)), []


# ---- probe dumps --------------------------------------------------------------------


DUMP_CURSOR = "epoch,last_updated"
# tasks a core at most: a task reads several files when there are very many
DUMP_TASKS = 16


def dump_marks(lake: Lake, table: str) -> tuple[int, int | None]:
    """(newest file read, newest row seen); the first run has no row cursor."""
    saved = lake.cursor(table)
    if saved is None:
        return 0, None
    epoch, row = saved.split(",")
    return int(epoch), int(row) if row else None


def run_dumps(
    lake: Lake,
    files: DataFrame,
    run_id: str,
    limit: int | None = None,
    order: str = "oldest",
    table: str = "site_sonar",
    drop_late: bool = True,
) -> DataFrame:
    """List, filter, limit, read, append; both marks are committed together with the rows.

    ``files`` is (epoch, url) of dumps on shared storage. With ``drop_late``, rows older
    than the newest row of earlier runs are left out and counted as ``late``; a first run keeps all rows.
    """
    mark, newest = dump_marks(lake, table)
    chosen = dumps.take_files(dumps.newer_than(files, mark), limit, order)
    # numbers only: the names of the files stay on the executors
    found = chosen.agg(F.count("*").alias("n"), F.max("epoch").alias("top")).first()
    listed, top, late = files.count(), max(mark, found.top or mark), 0
    if found.n:
        tasks = min(found.n, DUMP_TASKS * lake.spark.sparkContext.defaultParallelism)
        rows = dumps.probe_rows(dumps.stored_lines(chosen, tasks))
        seen = Observation()
        behind = F.col("last_updated") < F.lit(newest if drop_late else None).cast("bigint")
        rows = rows.observe(seen, F.max("last_updated").alias("top"), F.count_if(behind).alias("late"))
        rows = not_late(rows, newest if drop_late else None)

        def marks() -> tuple[str, str]:
            known = [value for value in (newest, observed(seen).get("top")) if value is not None]
            return DUMP_CURSOR, f"{top},{max(known) if known else ''}"

        lake.append(table, rows, cursor=marks, run_id=run_id)
        late = observed(seen).get("late", 0)
    return lake.spark.createDataFrame(
        [(listed, found.n, mark, top, late, 0)],
        "listed bigint, read bigint, mark_before bigint, mark_after bigint, late bigint, exit_code int",
    )


# ---- retention ----------------------------------------------------------------------


def run_retention(
    landing: Lake,
    lake: Lake,
    now: datetime,
    days: int = RETENTION_DAYS,
    frozen: Mapping[str, int] | None = None,
) -> DataFrame:
    """Delete old landing rows that the lake holds; verdict per table plus a total.

    Candidates come from one frozen version of the landing tables (``frozen`` maps a
    table to a version, default: the newest at the start). ``mon_jdls`` goes first:
    its age depends on ``job_info`` rows that the same pass deletes.
    """
    cutoff = now - timedelta(days=days)
    spark = landing.spark
    heads = {s.landing: (frozen or {}).get(s.landing) or landing.head(s.landing).snapshot_id for s in SERVED}
    at = {name: landing.read(name, snapshot_id=version) for name, version in heads.items()}
    held = {s.landing: lake.read(s.lake).select("job_id") for s in SERVED}
    candidates = {
        "job_info": retention.old_jobs(at["job_info"], cutoff),
        "trace": retention.old_traces(at["trace"], cutoff),
        "mon_jdls": retention.old_jdls(at["mon_jdls"], at["job_info"], cutoff),
    }
    guard = retention.plausibility(at["trace"], candidates["trace"]).collect()[0]
    if not guard.plausible:
        return spark.createDataFrame(
            [("abort", 0, 0, 0, 1)],
            "table string, kept bigint, deleted bigint, unverified bigint, exit_code int",
        )
    rows = []
    for name in ("mon_jdls", "job_info", "trace"):
        checked = landing.stage(retention.presence(candidates[name], held[name]), f"checked_{name}")
        verified = checked.filter("verified").select("job_id")
        missing = checked.filter("not verified").count()
        current = landing.read(name)
        if name == "mon_jdls":
            doomed = retention.deletable_jdls(current, landing.read("job_info"), verified, cutoff)
        elif name == "job_info":
            doomed = retention.deletable_jobs(current, verified, cutoff)
        else:
            doomed = retention.deletable_traces(current, verified, cutoff)
        if missing:
            # a report of the smallest keys without proof; it decides nothing
            report = retention.audit_sample(checked).select(F.lit(name).alias("landing"), "job_id", F.lit(now).alias("checked_at"))
            lake.append("retention_audit", report)
        rows.append((name, missing, landing.delete(name, doomed), missing))
    outcomes = spark.createDataFrame(
        rows, "table string, kept bigint, deleted bigint, unverified bigint"
    )
    return retention.rollup(outcomes)


# ---- freshness and upkeep ------------------------------------------------------------


def check_freshness(
    lake: Lake, now: datetime, tables: Iterable[str] = CORE_TABLES, max_age_hours: int = MAX_AGE_HOURS
) -> DataFrame:
    """Staleness of each expected table; code 1 if any is stale."""
    expected = lake.spark.createDataFrame([(name,) for name in tables], "table string")
    checked = freshness(lake.commits(), expected, F.lit(now), max_age_hours)
    return checked.withColumn("exit_code", F.col("stale").cast("int"))


def run_maintenance(lake: Lake, now: datetime, days: int = VERSION_DAYS) -> DataFrame:
    """Expire old versions of every table; an empty namespace is reported, not an error."""
    return lake.expire(now - timedelta(days=days))


def run_upkeep(lake: Lake, now: datetime, days: int = VERSION_DAYS) -> DataFrame:
    """Compact, expire, remove orphans, in this order; files before and after per table."""
    cutoff = now - timedelta(days=max(days, VERSION_DAYS))
    spark = lake.spark
    before = lake.current_files().collect()
    for row in lake.tables().collect():
        lake.compact(row.table)
    lake.expire(cutoff)
    lake.remove_orphans(cutoff)
    after = lake.current_files().collect()
    kind = "table string, files bigint, bytes bigint"
    return upkeep_delta(spark.createDataFrame(before, kind), spark.createDataFrame(after, kind), "files")


# ---- contract and export -------------------------------------------------------------


def publish_contract(
    lake: Lake, strict: bool = False, tables: Mapping[str, contract.ContractTable] = contract.TABLES
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Check drift both ways; unless a selected column is missing, publish the views in the lake.

    Returns the verdict (code 2 on blocking or, when strict, additive drift) and the views.
    """
    spark = lake.spark
    live = None
    for name in tables:
        rows = schema_rows(lake.read(name), name)
        if name == "mon_jdls_parsed" and lake.exists(KEYS):
            # keys without a column are as new as a new column
            seen = lake.read(KEYS).select(F.lit(name).alias("table"), "column", F.lit("string").alias("type")).distinct()
            rows = rows.unionByName(seen.join(rows, ["table", "column"], "left_anti"))
        live = rows if live is None else live.unionByName(rows)
    differences = drift(live, contract_rows(spark, tables.values()))
    verdict = drift_verdict(differences, strict)
    views: dict[str, DataFrame] = {}
    if verdict.collect()[0].applied:
        for name, spec in tables.items():
            views[name] = contract.project(lake.read(name), spec)
        _publish_views(lake, tables)
    return verdict, views


VIEWS = "contract_views"


def _publish_views(lake: Lake, tables: Mapping[str, contract.ContractTable]) -> None:
    """Keep the definitions in the lake, where any later session finds them."""
    stamp = time.time_ns()
    rows = [
        (stamp, name, position, column, source, spec.null_type)
        for name, spec in tables.items()
        for position, (column, source) in enumerate(contract.view_columns(spec))
    ]
    kind = "published bigint, view string, position int, column string, source string, null_type string"
    lake.append(VIEWS, lake.spark.createDataFrame(rows, kind))


def contract_view(lake: Lake, name: str) -> DataFrame:
    """The view as it was last published, over the newest version of its table."""
    newest = F.max("published").over(Window.partitionBy("view"))
    stored = lake.read(VIEWS).filter(F.col("view") == name).withColumn("newest", newest).filter("published = newest")
    columns = stored.orderBy("position").collect()  # one row a column
    if not columns:
        raise LookupError(f"{name}: no such view was published")
    return lake.read(name).select(
        *[(F.col(f"`{c.source}`") if c.source else F.lit(None).cast(c.null_type)).alias(c.column) for c in columns]
    )


def run_export(
    lake: Lake, target: str, now: datetime | None = None, tables: Iterable[str] = tuple(contract.TABLES)
) -> DataFrame:
    """Each table to its own Parquet dataset, then the manifest."""
    spark: SparkSession = lake.spark
    versions = {row.table: row.snapshot_id for row in latest_version(lake.commits()).collect()}
    rows = []
    for name in tables:
        schema, source, reason = export.readable_source(
            # the version that the manifest names, whatever is committed meanwhile
            lambda name=name: contract.project(lake.read(name, versions[name]), contract.TABLES[name]),
            lambda name=name: lake.read(name, versions[name]),
            name,
        )
        output = f"{name}.parquet"
        count = export.write_counted(source, f"{target}/{output}")
        rows.append((name, f"{schema}.{name}", schema, count, versions[name], output, reason))
    frame = export.manifest(spark, rows, now or datetime.now(timezone.utc))
    export.write_manifest(frame, target)
    return frame
