"""Counts, key census, reconciliation and freshness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.functions.names import PREFIX, snake_column
from telemill.operators.keys import row_text

# Tables a freshness check expects, and how old they may be.
CORE_TABLES = ("job_info", "trace", "mon_jdls_parsed")
MAX_AGE_HOURS = 26
RETENTION_DAYS = 14
VERSION_DAYS = 7


def table_counts(tables: Mapping[str, DataFrame], key: str = "job_id") -> DataFrame:
    """(table, rows, keys, duplicates) per table.

    Keys are counted by grouping twice, so a repeated key is folded before the shuffle.
    """
    counted = [
        df.groupBy(key)
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.count(key).alias("keys"),
        )
        .select(F.lit(name).alias("table"), "rows", "keys", (F.col("rows") - F.col("keys")).alias("duplicates"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def key_census(decoded: DataFrame) -> DataFrame:
    """(key, column, rows, filled): how often each JDL key occurs and is not null."""
    keys = decoded.select(F.explode("jdl").alias("key", "value")).groupBy("key").agg(
        F.count("*").alias("rows"), F.count("value").alias("filled")
    )
    return keys.select(
        "key", F.concat(F.lit(PREFIX), snake_column(F.col("key"))).alias("column"), "rows", "filled"
    )


def parse_report(decoded: DataFrame) -> DataFrame:
    """One row: rows, decoded, flagged with text, flagged without text."""
    ok = F.col("jdl_parse_ok")
    return decoded.agg(
        F.count("*").alias("rows"),
        F.count_if(ok).alias("parsed"),
        F.count("full_jdl_raw").alias("kept_raw"),
        F.count_if(~ok & F.col("full_jdl_raw").isNull()).alias("null_input"),
    )


def fill_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, filled, rows): non-null count of each column, in one pass."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count(F.col(c)).alias(c) for c in columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("filled")) for c in columns]
    )
    return counts.select(F.explode(pairs).alias("p"), F.col("_rows").alias("rows")).select(
        "p.column", "p.filled", "rows"
    )


def _fingerprint(df: DataFrame, key: str, columns: Sequence[str], name: str) -> DataFrame:
    """(key, name): row count and order-free content sums (120 hash bits) of each key's rows."""

    def part(start: int) -> Column:
        return F.conv(F.substring("_md5", start, 15), 16, 10).cast("decimal(20,0)")

    digests = df.select(key, F.md5(row_text(df, columns)).alias("_md5"))
    return digests.groupBy(key).agg(
        F.struct(F.count("*"), F.sum(part(1)), F.sum(part(16))).alias(name)
    )


def compare(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, verdict) with verdict same, changed, missing (left only) or extra (right only).

    Rows are folded to one fingerprint per key before the join.
    """
    both = _fingerprint(left, key, columns, "_l").join(
        _fingerprint(right, key, columns, "_r"), key, "full_outer"
    )
    verdict = (
        F.when(F.col("_r").isNull(), "missing")
        .when(F.col("_l").isNull(), "extra")
        .when(F.col("_l") == F.col("_r"), "same")
        .otherwise("changed")
    )
    return both.select(key, verdict.alias("verdict"))


def reconcile(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(verdict, keys): how many keys are the same, changed, missing or extra."""
    return compare(left, right, key, columns).groupBy("verdict").agg(F.count("*").alias("keys"))


def freshness(
    commits: DataFrame, expected: DataFrame, now: Column, max_age_hours: int = MAX_AGE_HOURS
) -> DataFrame:
    """(table, last_data_s, age_s, stale) for each expected table.

    Compaction commits (``replace``) do not count. A table without data is stale;
    an age of exactly the limit is fresh.
    """
    data = commits.filter(F.col("operation") != "replace")
    last = data.groupBy("table").agg(F.max("committed_at").alias("_last"))
    last_s = F.unix_micros(F.col("_last").cast("timestamp"))
    age = F.unix_micros(now) - last_s
    limit = max_age_hours * 3600 * 1_000_000
    return expected.join(last, "table", "left").select(
        "table",
        F.expr("unix_seconds(cast(_last as timestamp))").alias("last_data_s"),
        (age / 1_000_000).cast("bigint").alias("age_s"),
        F.coalesce(age > limit, F.lit(True)).alias("stale"),
    )


def upkeep_delta(before: DataFrame, after: DataFrame, measure: str) -> DataFrame:
    """(table, before, after, removed) plus a total row (table ``total``)."""
    joined = before.select("table", F.col(measure).alias("b")).join(
        after.select("table", F.col(measure).alias("a")), "table", "full_outer"
    )
    zero = F.lit(0).cast("bigint")
    filled = joined.select("table", F.coalesce("b", zero).alias("b"), F.coalesce("a", zero).alias("a"))
    return filled.rollup("table").agg(F.sum("b").alias("before"), F.sum("a").alias("after")).select(
        F.coalesce("table", F.lit("total")).alias("table"),
        "before",
        "after",
        (F.col("before") - F.col("after")).alias("removed"),
    )
