"""Digests of key ranges: which ranges of two tables differ, without reading their rows a second time.

A digest is the number of rows of a range and the sum of two hashes of each, so it does not depend on the order of
rows, combines before a shuffle, and digests of ranges add up to that of a larger range. Ranges are ``width`` keys
wide; a level of the tree joins ``FANOUT`` ranges of the level below.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.operators.keys import row_text
from telemill.operators.quality import reconcile

FANOUT = 64
_SUMS = ("rows", "a", "b")


def range_of(key: str, width: int) -> Column:
    """The number of the range a key is in; a null key has a range of its own."""
    return F.expr(f"(`{key}` - pmod(`{key}`, {width}L)) div {width}L")


def range_digests(df: DataFrame, key: str, width: int, columns: Sequence[str]) -> DataFrame:
    """(range, rows, a, b) of each key range, over the columns named."""
    text = row_text(df, list(columns))
    hashed = df.select(
        range_of(key, width).alias("range"),
        F.xxhash64(text).cast("decimal(38,0)").alias("a"),
        F.xxhash64(F.lit("second"), text).cast("decimal(38,0)").alias("b"),
    )
    return hashed.groupBy("range").agg(F.count("*").alias("rows"), F.sum("a").alias("a"), F.sum("b").alias("b"))


def parents(digests: DataFrame) -> DataFrame:
    """The digests one level up."""
    above = range_of("range", FANOUT)
    return digests.groupBy(above.alias("range")).agg(*[F.sum(name).alias(name) for name in _SUMS])


def _apart(left: DataFrame, right: DataFrame, within: DataFrame | None) -> DataFrame:
    """(range): the ranges of one level, below those of ``within``, whose digests differ or that one side lacks."""
    if within is not None:
        above = range_of("range", FANOUT).eqNullSafe(F.col("above"))
        below = within.select(F.col("range").alias("above"))
        left, right = left.join(below, above, "left_semi"), right.join(below, above, "left_semi")
    here = left.select("range", F.struct(*_SUMS).alias("l"))
    there = right.select(F.col("range").alias("other"), F.struct(*_SUMS).alias("r"))
    both = here.join(there, F.col("range").eqNullSafe(F.col("other")), "full_outer")
    # a null range is a range: it is found on the side that has it
    return both.filter(~F.col("l").eqNullSafe(F.col("r"))).select(F.coalesce("range", "other").alias("range"))


def differing_ranges(left: DataFrame, right: DataFrame, levels: int = 2) -> DataFrame:
    """(range) of two tables of digests that differ, sought from the top of the tree downwards."""
    tree = [(left, right)]
    for _ in range(levels):
        tree.append((parents(tree[-1][0]), parents(tree[-1][1])))
    found = None
    for here, there in reversed(tree):
        found = _apart(here, there, found)
    return found


def rows_in(df: DataFrame, key: str, width: int, ranges: DataFrame) -> DataFrame:
    """The rows whose key lies in one of the ranges."""
    wanted = ranges.select(F.col("range").alias("_range"))
    return df.join(wanted, range_of(key, width).eqNullSafe(F.col("_range")), "left_semi")


def reconcile_by_ranges(
    left: DataFrame, right: DataFrame, key: str, columns: Sequence[str], width: int, levels: int = 2
) -> tuple[DataFrame, DataFrame]:
    """The verdict of ``reconcile``, and how much was read for it.

    Keys are unique on each side, as after a merge. Only the rows of ranges whose digests differ are compared one by
    one; the others are equal by their digests.
    The second frame is one row: rows of both sides, rows read a second time, and ranges that differ.
    """
    digests = [range_digests(df, key, width, columns) for df in (left, right)]
    ranges = differing_ranges(*digests, levels)
    again = [rows_in(df, key, width, ranges) for df in (left, right)]
    compared = reconcile(again[0], again[1], key, columns)
    wanted = ranges.select(F.col("range").alias("_range"))
    equal = digests[0].join(wanted, F.col("range").eqNullSafe(F.col("_range")), "left_anti")
    same = equal.agg(F.lit("same").alias("verdict"), F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("keys"))
    verdict = compared.unionByName(same.filter("keys > 0")).groupBy("verdict").agg(F.sum("keys").alias("keys"))
    counts = [
        digests[0].unionByName(digests[1]).select(F.lit("rows").alias("what"), F.col("rows").alias("n")),
        *[rows.select(F.lit("read_again").alias("what"), F.lit(1).cast("bigint").alias("n")) for rows in again],
        ranges.select(F.lit("ranges").alias("what"), F.lit(1).cast("bigint").alias("n")),
    ]
    names = ("rows", "read_again", "ranges")
    of = lambda name: F.coalesce(F.sum(F.when(F.col("what") == name, F.col("n"))), F.lit(0)).alias(name)
    return verdict, reduce(DataFrame.unionByName, counts).agg(*map(of, names))


def changed_rows(source: DataFrame, stored: DataFrame, key: str, width: int, columns: Sequence[str], passed: Column | None = None) -> DataFrame:
    """Rows of ranges that changed since their digests were stored, for a scan whose cursor is behind them.

    ``passed`` is a condition on ``range`` that picks the ranges due this time, so that a rolling scan goes over all
    of them in turn. Ranges with equal digests are not fetched.
    """
    now = range_digests(source, key, width, columns)
    if passed is not None:
        now, stored = now.filter(passed), stored.filter(passed)
    return rows_in(source, key, width, _apart(now, stored, None))
