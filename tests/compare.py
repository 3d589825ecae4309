"""Run registered queries against their SQL: row count, columns and values."""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def plain(value: object) -> object:
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides agree, else the first difference."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = rows_of(names, cursor.fetchall())
    got = rows_of(spark_df.columns, spark_df.collect())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    if len(got) != len(expected):
        only = [r for r in got if r not in set(expected)][:2] if len(got) < 200_000 else []
        return f"{len(got)} rows, expected {len(expected)}; e.g. {only}"
    for left, right in zip(got, expected):
        if left != right:
            return f"{left} != {right}"
    return None


def main(folder: str, wanted: list[str]) -> int:
    import __spark_entry__ as entry
    from telemill.session import build_session

    spark = build_session(
        master="local[8]",
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(folder), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            problem = differences(df, con, sqls[name]) if name in sqls else f"rows {df.count()} (no SQL)"
        except Exception as exc:  # noqa: BLE001 - report and go on
            problem = f"{type(exc).__name__}: {str(exc)[:600]}"
        ok = problem is None
        failed += not ok and "(no SQL)" not in problem
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
