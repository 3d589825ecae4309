"""Incremental scans: a closed lower bound on a cursor column, pushed to the source.

The bound is closed, so the boundary row is read again; the merge makes that
harmless. The literal always has the column's own type: a naive timestamp column
gets a naive literal, an integer column an integer, and the column is never cast.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Cursor:
    """Where an incremental scan of one table starts on its first run."""

    table: str
    column: str
    kind: str  # "naive" | "integer"
    initial: str


# Cursor columns and their first-run starts.
CURSORS = {
    "job_info": Cursor("job_info", "last_update", "naive", "2026-01-01T00:00:00"),
    "trace": Cursor("trace", "laststatuschangetimestamp", "integer", "0"),
    # updates to ids already passed are never read again
    "mon_jdls": Cursor("mon_jdls", "job_id", "integer", "0"),
}

# Rows fetched per round trip from the landing database.
FETCH_ROWS = {"job_info": 100_000, "trace": 100_000, "mon_jdls": 20_000}


def checked_start(kind: str, value: str) -> str:
    """Validate a start value; naive cursors refuse a UTC offset, integers are unconverted."""
    if kind == "integer":
        return str(int(value))
    if kind != "naive":
        raise ValueError(f"unknown cursor kind {kind!r}")
    parsed = datetime.fromisoformat(value)
    if parsed.tzinfo is not None:
        raise ValueError(f"{value!r} has a UTC offset; the cursor column is a naive timestamp")
    return parsed.isoformat()


def start_value(cursor: Cursor, saved: str | None, override: str | None = None) -> str:
    """Saved cursor first; then the backfill override; then the first-run default."""
    if saved is not None:
        return saved
    return checked_start(cursor.kind, override or cursor.initial)


def cursor_literal(kind: str, value: str) -> Column:
    if kind == "integer":
        return F.lit(int(value))
    return F.lit(value).cast("timestamp_ntz")


def since(df: DataFrame, column: str, kind: str, value: str) -> DataFrame:
    """Rows at or after the cursor; NULL cursors are never selected."""
    return df.filter(F.col(column) >= cursor_literal(kind, value))


def cursor_report(df: DataFrame, column: str, kind: str, value: str) -> DataFrame:
    """One row: rows selected by the cursor, rows before it, rows it can never select."""
    at_or_after = F.col(column) >= cursor_literal(kind, value)
    return df.agg(
        F.count_if(at_or_after).alias("selected"),
        F.count_if(~at_or_after).alias("passed"),
        F.count_if(F.col(column).isNull()).alias("null_cursor"),
    )


def jdbc_options(
    url: str, table: str, lower: int | None = None, upper: int | None = None, partitions: int = 1
) -> dict[str, str]:
    """Reader options for a chunked, parallel scan split on ``job_id``."""
    options = {"url": url, "dbtable": table, "fetchsize": str(FETCH_ROWS.get(table, 100_000))}
    if partitions > 1:
        options |= {
            "partitionColumn": "job_id",
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def bounds_query(table: str, column: str, kind: str, start: str) -> str:
    """A subquery for the least and largest id at or after a cursor: what a parallel scan is split by."""
    literal = str(int(start)) if kind == "integer" else f"TIMESTAMP '{start.replace('T', ' ')}'"
    return f"(SELECT min(job_id) AS lo, max(job_id) AS hi FROM {table} WHERE {column} >= {literal}) AS bounds"


def split_of(lo: int | None, hi: int | None, partitions: int) -> dict[str, int]:
    """Reader bounds for ``partitions`` tasks; an empty or one-row range needs one."""
    if lo is None or hi is None or hi - lo < partitions:
        return {}
    return {"lower": int(lo), "upper": int(hi) + 1, "partitions": partitions}


def parallel_scan(spark: SparkSession, url: str, table: str, column: str, kind: str, start: str, partitions: int) -> DataFrame:
    """A landing table over JDBC, read by several connections at once between the cursor and the largest id."""
    options = jdbc_options(url, bounds_query(table, column, kind, start))
    row = spark.read.format("jdbc").options(**options).load().first()
    return landing_scan(spark, url, table, **split_of(row.lo, row.hi, partitions))


def landing_scan(spark: SparkSession, url: str, table: str, **split: int) -> DataFrame:
    """A landing table over JDBC; a cursor filter on top is sent to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **split)).option(
        "preferTimestampNTZ", "true"
    ).load()
