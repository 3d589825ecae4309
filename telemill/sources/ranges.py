"""Ranges of a key that hold about equally many rows, for extraction by several readers at once.

Even steps between the least and the largest key make one task of whatever is dense. A quantile sketch of the keys,
which combines before its one small shuffle, gives bounds with equal row counts instead; the driver sees the
bounds only. A single key that holds more than a range's share can be split further by another column.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemill.sources.cursors import jdbc_options, landing_scan

#: the sketch's rank error is one part in so many of a range's share
FINE = 100


@dataclass(frozen=True)
class KeyRange:
    """Keys from ``lo`` up to but without ``hi``; None is open. ``share`` of ``shares`` by a second column."""

    lo: int | None
    hi: int | None
    share: int = 0
    shares: int = 1

    def predicate(self, key: str, spread: str | None = None, nulls: bool = False) -> str:
        """The range as a condition that a database and Spark both read; the open first range takes null keys."""
        parts = [f"{key} >= {self.lo}" if self.lo is not None else "", f"{key} < {self.hi}" if self.hi is not None else ""]
        text = " AND ".join(part for part in parts if part) or "1 = 1"
        if nulls and self.lo is None:
            text = f"({text} OR {key} IS NULL)"
        # the remainder of a negative number is negative: its size counts
        return f"{text} AND abs(mod({spread}, {self.shares})) = {self.share}" if self.shares > 1 else text


def balanced_ranges(keys: DataFrame, key: str, ranges: int, split_hot: bool = False) -> list[KeyRange]:
    """``ranges`` ranges of about equal row counts; fewer where single keys fill whole ranges.

    With ``split_hot`` a key that fills several ranges gets as many shares of a second column.
    """
    steps = [k / ranges for k in range(1, ranges)]
    bounds = keys.agg(F.percentile_approx(key, steps, ranges * FINE).alias("b")).first().b if steps else []
    if not bounds:
        return [KeyRange(None, None)]
    # a whole number is an int whatever the key's type: as text, a large decimal may show as a float
    bounds = [int(bound) if bound == int(bound) else bound for bound in bounds]
    # a bound that repeats is a key that fills that many ranges and more
    repeats = {bound: bounds.count(bound) for bound in bounds}
    cuts = sorted({cut for bound, n in repeats.items() for cut in ((bound, bound + 1) if n > 1 else (bound,))})
    edges = [None, *cuts, None]
    out = []
    for lo, hi in zip(edges, edges[1:]):
        shares = repeats.get(lo, 1) if split_hot and lo is not None and hi == lo + 1 else 1
        out += [KeyRange(lo, hi, k, shares) for k in range(shares)]
    return out


def numbered(df: DataFrame, key: str, ranges: Sequence[KeyRange], spread: str | None = None) -> DataFrame:
    """The rows with the number of their range as ``part``."""
    conditions = [F.expr(r.predicate(f"`{key}`", spread and f"`{spread}`", nulls=True)) for r in ranges]
    first: Column = reduce(lambda rest, pair: F.when(pair[1], pair[0]).otherwise(rest), reversed(list(enumerate(conditions))), F.lit(None).cast("int"))
    return df.withColumn("part", first)


def range_counts(df: DataFrame, key: str, ranges: Sequence[KeyRange], spread: str | None = None) -> DataFrame:
    """(part, rows, lo, hi): what each range holds."""
    counted = numbered(df, key, ranges, spread).groupBy("part")
    return counted.agg(F.count("*").alias("rows"), F.min(key).alias("lo"), F.max(key).alias("hi"))


def balanced_scan(
    spark: SparkSession, url: str, table: str, partitions: int, key: str = "job_id", where: str = "1 = 1", **even: int
) -> DataFrame:
    """A landing table over JDBC in ranges of equal row counts.

    A first scan reads the keys alone (in even steps, ``even``), a second one whole rows by one predicate a range.
    """
    keys = landing_scan(spark, url, table, **even).filter(where).select(key)
    predicates = [f"({where}) AND {r.predicate(key, nulls=True)}" for r in balanced_ranges(keys, key, partitions)]
    options = {k: v for k, v in jdbc_options(url, table).items() if k not in ("url", "dbtable")} | {"preferTimestampNTZ": "true"}
    return spark.read.jdbc(url, table, predicates=predicates, properties=options)
