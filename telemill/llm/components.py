"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import written


def _star(pairs: DataFrame) -> DataFrame:
    """(u, v, least) for pairs (u, v): the least of u and all its v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("w"))
    return pairs.join(least, "u").select("u", "v", F.least("u", "w").alias("least"))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) for every node of the edges (u, v); a component is named by its least node.

    A round is two joins with the least neighbour of each node. The joins are plain equi-joins
    whose hot nodes adaptive execution splits; no neighbourhood is gathered anywhere, and each
    round is cut from its lineage by a table in the shared folder.
    """
    ordered = edges.filter(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = written(ordered.distinct(), f"{name}-edges")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        small = _star(large.filter("u != v").distinct())
        pairs = small.select(F.col("v").alias("u"), F.col("least").alias("v"))
        pairs = pairs.unionByName(small.select("u", F.col("least").alias("v")))
        now = written(pairs.filter("u != v").distinct(), f"{name}-edges")
        before, mark = mark, _mark(now)
        if before == mark:
            break
    rooted = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return rooted.unionByName(roots)
