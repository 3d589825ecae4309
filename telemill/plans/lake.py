"""Versioned lake tables as plain Parquet folders plus a commit log.

Each write adds data folders and then one commit row; readers see only what a
commit row names, so a job that dies half-way leaves nothing visible. A table that
a merge has written is keyed: its key and the width of its key ranges are part of
the commit row, every later write follows them, and a merge or delete rewrites only
the ranges it touches. A table of appended rows only has no ranges; a merge lays it
out once and a delete looks at all of it. A bucket holds the rows of ``width``
consecutive keys, so it is bounded where keys are unique.

The commit row also carries the cursor, so data and cursor move together.
Only table metadata (commit rows, bucket folders) passes through the driver.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemill import schemas
from telemill.operators.drift import schema_gate
from telemill.operators.keys import latest_per_key

BUCKET = "_bucket"
APPEND, REPLACE, OVERWRITE = "append", "replace", "overwrite"


class CommitConflictError(RuntimeError):
    """Another job committed the same table version first."""


class NullKeyError(ValueError):
    """A merge source holds rows without a key."""


@dataclass
class Lake:
    """A namespace of versioned tables below ``root`` on shared storage."""

    spark: SparkSession
    root: str
    width: int = 10_000_000

    # ---- metadata ---------------------------------------------------------------

    def _log_path(self, table: str | None = None) -> str:
        return f"{self.root}/commits" + (f"/table={table}" if table else "")

    def commits(self) -> DataFrame:
        """The commit log of every table in the namespace."""
        if not path_exists(self.spark, self._log_path()):
            return self.spark.createDataFrame([], schemas.COMMITS)
        return self.spark.read.schema(schemas.COMMITS).parquet(self._log_path())

    def tables(self) -> DataFrame:
        """Names of the tables in the namespace, sorted."""
        return self.commits().select("table").distinct().orderBy("table")

    def head(self, table: str, snapshot_id: int | None = None, as_of: datetime | None = None) -> Row | None:
        """The newest commit row, or the one a version or time names."""
        log = self.commits().filter(F.col("table") == table)
        if snapshot_id is not None:
            log = log.filter(F.col("snapshot_id") == snapshot_id)
        if as_of is not None:
            log = log.filter(F.col("committed_at") <= F.lit(as_of))
        rows = log.orderBy(F.col("sequence_number").desc()).limit(1).collect()
        return rows[0] if rows else None

    def exists(self, table: str) -> bool:
        return self.head(table) is not None

    def state(self) -> DataFrame:
        """(resource, cursor_kind, cursor_value, run_id, updated_at): the newest saved cursor."""
        saved = self.commits().filter(F.col("cursor_value").isNotNull())
        newest = F.max_by(
            F.struct("cursor_kind", "cursor_value", "run_id", F.col("committed_at").alias("updated_at")),
            "sequence_number",
        )
        return saved.groupBy(F.col("table").alias("resource")).agg(newest.alias("s")).select("resource", "s.*")

    def cursor(self, table: str) -> str | None:
        rows = self.state().filter(F.col("resource") == table).select("cursor_value").collect()
        return rows[0][0] if rows else None

    def files(self) -> DataFrame:
        """(table, path) of each data folder that a retained version references."""
        return self.commits().select("table", F.explode("parts.path").alias("path")).distinct()

    def current_files(self) -> DataFrame:
        """(table, files, bytes) of the current version of each table."""
        head = self.commits().groupBy("table").agg(F.max_by("parts", "sequence_number").alias("p"))
        folders = head.select("table", F.explode("p.path").alias("folder"))
        return (
            self._stored_files()
            .join(folders, ["table", "folder"], "left_semi")
            .groupBy("table")
            .agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
        )

    def _stored_files(self, table: str | None = None) -> DataFrame:
        """(table, folder, path, bytes, modified_at) of the data files of one table or of all; reads no content."""
        folder = f"{self.root}/data" + (f"/{table}" if table else "")
        if not path_exists(self.spark, folder):
            empty = "table string, folder string, path string, bytes bigint, modified_at timestamp"
            return self.spark.createDataFrame([], empty)
        stored = (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
            .load(folder)
        )
        # paths below the root, which may itself hold any segment
        prefix = qualified(self.spark, self.root) + "/"
        below = F.when(F.startswith("path", F.lit(prefix)), F.substring("path", len(prefix) + 1, 1 << 30))
        place = F.regexp_extract(below, "^(data/.*)/[^/]+$", 1)
        return stored.select(
            F.regexp_extract(place, "^data/([^/]+)/", 1).alias("table"),
            place.alias("folder"),
            "path",
            F.col("length").alias("bytes"),
            F.col("modificationTime").alias("modified_at"),
        )

    # ---- reads ------------------------------------------------------------------

    def read(self, table: str, snapshot_id: int | None = None, as_of: datetime | None = None) -> DataFrame:
        """The table at its newest version, or at a version or time until that expires."""
        commit = self.head(table, snapshot_id, as_of)
        if commit is None:
            raise LookupError(f"{table}: no such table or version")
        return self._load(commit, [part.path for part in commit.parts])

    def _load(self, commit: Row, paths: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(commit.table_schema))
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{path}" for path in paths])

    # ---- writes -----------------------------------------------------------------

    def _layout(self, head: Row | None) -> tuple[str | None, int]:
        """Key and range width of a table as its commit rows have them."""
        return (head.key, head.width) if head and head.key else (None, self.width)

    def _write(self, df: DataFrame, table: str, key: str | None, width: int) -> list[Row]:
        """Write data folders; returns (bucket, path, records) for each, from file footers."""
        base = f"data/{table}/{uuid.uuid4().hex}"
        # ranges of equal width on both sides of zero
        bucket = F.expr(f"(`{key}` - pmod(`{key}`, {width}L)) div {width}L") if key else F.lit(0).cast("bigint")
        bucketed = df.withColumn(BUCKET, bucket)
        # adaptive rebalancing: small buckets share tasks, a large one is split over many
        out = bucketed.hint("rebalance", BUCKET) if key else bucketed
        out.write.partitionBy(BUCKET).parquet(f"{self.root}/{base}")
        written = self.spark.read.schema(
            T.StructType(list(df.schema) + [T.StructField(BUCKET, T.LongType())])
        ).parquet(f"{self.root}/{base}")
        rows = written.groupBy(BUCKET).count().collect()
        return [
            Row(bucket=row[BUCKET], path=f"{base}/{BUCKET}={row[BUCKET]}", records=row["count"])
            for row in sorted(rows, key=lambda row: (row[BUCKET] is None, row[BUCKET]))
        ]

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """A frame written once and read back: computed once, and cut from its lineage.

        The folder belongs to no version, so orphan removal clears it later.
        """
        folder = f"{self.root}/data/staged_{name}/{uuid.uuid4().hex}"
        df.write.parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def _commit(
        self,
        table: str,
        head: Row | None,
        operation: str,
        parts: list[Row],
        schema: T.StructType,
        cursor: tuple[str, str] | None = None,
        run_id: str | None = None,
        committed_at: datetime | None = None,
        layout: tuple[str | None, int] | None = None,
    ) -> int:
        key, width = layout or self._layout(head)
        sequence = (head.sequence_number if head else 0) + 1
        snapshot = time.time_ns()
        row = {
            "snapshot_id": snapshot,
            "committed_at": committed_at or datetime.now(timezone.utc),
            "operation": operation,
            "path": f"data/{table}",
            "total_records": sum(part.records for part in parts),
            "cursor_kind": cursor[0] if cursor else None,
            "cursor_value": cursor[1] if cursor else None,
            "run_id": run_id,
            "table_schema": schema.json(),
            "key": key,
            "width": width,
            "parts": [part.asDict() for part in parts],
        }
        log_schema = T.StructType(
            [f for f in schemas.COMMITS if f.name not in ("table", "sequence_number")]
        )
        record = self.spark.createDataFrame([row], log_schema).coalesce(1)
        # readers pass over names that begin with an underscore; a rename to a file that is there fails
        waiting = f"{self._log_path()}/_waiting-{uuid.uuid4().hex}"
        record.write.parquet(waiting)
        try:
            publish(self.spark, waiting, f"{self._log_path(table)}/sequence_number={sequence}/commit.parquet")
        except FileExistsError as exc:
            raise CommitConflictError(f"{table}: version {sequence} was committed by another job") from exc
        finally:
            remove_path(self.spark, waiting)
        return snapshot

    def already_done(self, table: str, run_id: str) -> bool:
        """True when a retained commit of the table was made by this run (replay fence)."""
        log = self.commits().filter((F.col("table") == table) & (F.col("run_id") == run_id))
        return not log.limit(1).isEmpty()

    def upsert(
        self,
        table: str,
        source: DataFrame,
        key: str = "job_id",
        cursor: tuple[str, str] | None = None,
        run_id: str | None = None,
        unique: bool = False,
        blank: Sequence[str] = (),
        **commit: datetime,
    ) -> int | None:
        """Update matched keys, insert the others; returns the new version.

        ``cursor`` is (column, kind); its largest value is saved with the commit.
        A source without rows commits nothing. ``unique`` skips the choice of one
        row per key for a source that is known to hold one. ``blank`` names columns that are
        null in every row of the source: they stand in the schema, and need not be written.
        """
        head = self.head(table)
        current = T.StructType.fromJson(json.loads(head.table_schema)) if head else None
        schema = schema_gate(current, _nullable(source.schema))
        source = source.drop(*blank)
        seen = Observation()
        top = F.max(F.col(cursor[0])).cast("string") if cursor else F.lit(None).cast("string")
        watched = source.observe(
            seen, F.count_if(F.col(key).isNull()).alias("null_keys"), top.alias("top")
        )
        chosen = watched if unique else latest_per_key(watched, key, cursor[0] if cursor else None)
        laid, width = self._layout(head)
        staged = self._write(chosen, table, key, width)
        if not staged:  # nothing came, so nothing was observed either
            return None
        if seen.get["null_keys"]:
            raise NullKeyError(f"{table}: {seen.get['null_keys']} row(s) without {key}")
        mark = (cursor[1], _cursor_text(cursor[1], seen.get["top"])) if cursor else None
        parts = list(head.parts) if head else []
        # a bucket may have several folders; a table laid out by no or another key is rewritten once
        hit = {part.bucket for part in staged}
        touched = parts if laid != key else [part for part in parts if part.bucket in hit]
        kept = [part for part in parts if part not in touched]
        fresh = staged
        if touched:
            mixed = {part.bucket for part in touched} if laid == key else hit
            again = [part for part in staged if part.bucket in mixed]
            new_rows = self.spark.read.schema(_nullable(source.schema)).parquet(*[f"{self.root}/{part.path}" for part in again])
            old_rows = self._load(head, [part.path for part in touched]).join(new_rows.select(key), key, "left_anti")
            merged = old_rows.unionByName(new_rows, allowMissingColumns=True)
            fresh = [part for part in staged if part.bucket not in mixed] + self._write(merged, table, key, width)
        return self._commit(table, head, APPEND, kept + fresh, schema, mark, run_id, layout=(key, width), **commit)

    def append(
        self,
        table: str,
        source: DataFrame,
        cursor: tuple[str, str] | Callable[[], tuple[str, str]] | None = None,
        run_id: str | None = None,
        **commit: datetime,
    ) -> int | None:
        """Add rows; a run that already committed adds nothing.

        ``cursor`` is (kind, value), or a function that gives it once the rows are written.
        """
        if run_id is not None and self.already_done(table, run_id):
            return None
        head = self.head(table)
        current = T.StructType.fromJson(json.loads(head.table_schema)) if head else None
        schema = schema_gate(current, _nullable(source.schema))
        added = self._write(source, table, *self._layout(head))
        if not added and cursor is None:
            return None
        parts = (list(head.parts) if head else []) + added
        saved = cursor() if callable(cursor) else cursor
        return self._commit(table, head, APPEND, parts, schema, saved, run_id, **commit)

    def delete(self, table: str, doomed: DataFrame, key: str = "job_id", **commit: datetime) -> int:
        """Remove the rows whose key is in ``doomed``; returns how many rows went."""
        head = self.head(table)
        if head is None:
            return 0
        laid, width = self._layout(head)
        staged = self._write(doomed.select(key).distinct(), f"staged_{table}", key, width)
        hit = {part.bucket for part in staged}
        touched = [part for part in head.parts if part.bucket in hit or laid != key] if staged else []
        if not touched:
            return 0
        keys = self.spark.read.schema(T.StructType([doomed.schema[key]])).parquet(
            *[f"{self.root}/{part.path}" for part in staged]
        )
        kept = self._load(head, [part.path for part in touched]).join(keys, key, "left_anti")
        rewritten = self._write(kept, table, laid, width)
        removed = sum(p.records for p in touched) - sum(p.records for p in rewritten)
        if removed:
            others = [part for part in head.parts if part not in touched]
            schema = T.StructType.fromJson(json.loads(head.table_schema))
            self._commit(table, head, OVERWRITE, others + rewritten, schema, **commit)
        return removed

    # ---- upkeep -----------------------------------------------------------------

    def compact(self, table: str, small: int = 128 << 20, **commit: datetime) -> int | None:
        """Rewrite folders that hold small files together with others; rows and layout stay the same.

        The commit is marked ``replace``: it must not count as fresh data.
        """
        head = self.head(table)
        if head is None:
            return None
        key, width = self._layout(head)
        files = self._stored_files(table).groupBy("folder").agg(F.count_if(F.col("bytes") < small).alias("small"))
        tiny = {row.folder: row.small for row in files.filter("small > 0").collect()}
        loose = [part for part in head.parts if part.path in tiny]
        if key:
            # a range is worth a rewrite if it has several small files, in one folder or in more
            count: dict[int, int] = {}
            for part in loose:
                count[part.bucket] = count.get(part.bucket, 0) + tiny[part.path]
            loose = [part for part in loose if count[part.bucket] > 1]
        if sum(tiny[part.path] for part in loose) < 2:
            return None
        rows = self._load(head, [part.path for part in loose])
        packed = self._write(rows if key else rows.hint("rebalance"), table, key, width)
        parts = [part for part in head.parts if part not in loose] + packed
        schema = T.StructType.fromJson(json.loads(head.table_schema))
        return self._commit(table, head, REPLACE, parts, schema, **commit)

    def expire(self, cutoff: datetime) -> DataFrame:
        """Drop versions older than the cutoff, never a table's newest one.

        Returns (table, versions_before, versions_after, expired). The newest saved
        cursor of a table is kept with its commit row even when that row is old.
        """
        log = self.commits()
        counts = expired_versions(log, cutoff)
        totals = {row.table: row for row in counts.collect()}
        doomed = (
            expiring(log, cutoff)
            .select(
                F.concat(
                    F.lit(self._log_path() + "/table="), "table",
                    F.lit("/sequence_number="), "sequence_number",
                ).alias("path")
            )
        )
        _remove(doomed)
        return self.spark.createDataFrame(
            [tuple(row) for row in totals.values()], counts.schema
        )

    def orphans(self, cutoff: datetime) -> DataFrame:
        """Data files that no retained version references and that are older than the cutoff."""
        return orphan_files(self._stored_files(), self.files(), cutoff)

    def remove_orphans(self, cutoff: datetime) -> int:
        """Remove them; refused if a current version names a folder that no stored file belongs to."""
        heads = self.commits().groupBy("table").agg(F.max_by("parts", "sequence_number").alias("parts"))
        named = heads.select("table", F.explode("parts").alias("part")).filter("part.records > 0")
        lost = named.select("table", F.col("part.path").alias("folder")).join(self._stored_files(), ["table", "folder"], "left_anti")
        if not lost.isEmpty():
            raise RuntimeError(f"stored files of a current version are missing or not recognised below {self.root}")
        return _remove(self.orphans(cutoff).select("path"))

    def reset(self, confirm: bool = False) -> None:
        """Remove every table and every cursor of the namespace; both go together."""
        if not confirm:
            raise ValueError("reset removes all tables and cursors: pass confirm=True")
        folders = [(f"{self.root}/commits",), (f"{self.root}/data",)]
        _remove(self.spark.createDataFrame(folders, "path string"))


# ---- the same rules as plain transforms on metadata frames --------------------------


def expiring(commits: DataFrame, cutoff: datetime | Column) -> DataFrame:
    """Commit rows older than the cutoff, except each table's head and newest cursor row."""
    cutoff = cutoff if isinstance(cutoff, Column) else F.lit(cutoff)
    heads = commits.groupBy("table").agg(
        F.max("sequence_number").alias("head"),
        F.max(F.when(F.col("cursor_value").isNotNull(), F.col("sequence_number"))).alias("saved"),
    )
    return (
        commits.join(heads, "table")
        .filter(F.col("committed_at") < cutoff)
        .filter(F.col("sequence_number") != F.col("head"))
        .filter(F.col("sequence_number") != F.coalesce("saved", F.lit(-1)))
        .drop("head", "saved")
    )


def expired_versions(commits: DataFrame, cutoff: datetime | Column) -> DataFrame:
    """(table, versions_before, versions_after, expired) per table."""
    gone = expiring(commits, cutoff).groupBy("table").agg(F.count("*").alias("expired"))
    before = commits.groupBy("table").agg(F.count("*").alias("versions_before"))
    expired = F.coalesce("expired", F.lit(0).cast("bigint"))
    return before.join(gone, "table", "left").select(
        "table",
        "versions_before",
        (F.col("versions_before") - expired).alias("versions_after"),
        expired.alias("expired"),
    )


def latest_version(commits: DataFrame) -> DataFrame:
    """(table, snapshot_id) with the highest sequence number of each table."""
    return commits.groupBy("table").agg(F.max_by("snapshot_id", "sequence_number").alias("snapshot_id"))


def orphan_files(stored: DataFrame, referenced: DataFrame, cutoff: datetime | Column) -> DataFrame:
    """Stored files whose folder no retained version names, older than the cutoff."""
    cutoff = cutoff if isinstance(cutoff, Column) else F.lit(cutoff)
    named = referenced.select("table", F.col("path").alias("folder"))
    return stored.filter(F.col("modified_at") < cutoff).join(named, ["table", "folder"], "left_anti")


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def _cursor_text(kind: str, value: str | None) -> str | None:
    return value.replace(" ", "T") if value and kind == "naive" else value


def qualified(spark: SparkSession, path: str) -> str:
    """The path as the file system itself spells it, and as file listings show it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def remove_path(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def publish(spark: SparkSession, folder: str, target: str) -> None:
    """Move the one Parquet file of a folder to a name that must be free, in one rename.

    The rename of a file without overwriting is atomic on HDFS and on object stores with such
    a rename; a folder that a dead writer left behind holds no such file and is in nobody's way.
    """
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    place = hadoop.fs.Path(folder)
    found = [s.getPath() for s in place.getFileSystem(conf).listStatus(place) if s.getPath().getName().endswith(".parquet")]
    goal = hadoop.fs.Path(target)
    system = goal.getFileSystem(conf)
    system.mkdirs(goal.getParent())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        hadoop.fs.FileContext.getFileContext(goal.toUri(), conf).rename(
            system.makeQualified(found[0]), system.makeQualified(goal), options
        )
    except Py4JJavaError as exc:
        if system.exists(goal):
            raise FileExistsError(target) from exc
        raise


def _remove(paths: DataFrame) -> int:
    """Delete files or folders through the file system that Spark reads with; returns how many were there."""
    spark = paths.sparkSession
    return sum(remove_path(spark, row.path) for row in paths.select("path").toLocalIterator())
