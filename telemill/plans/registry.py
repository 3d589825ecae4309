"""A named query: what it computes in Spark, and the same result in plain SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from telemill.plans.domain import Given

Run = Callable[[Given], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Run
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        # naive and zoned times are compared in UTC, whoever made the session
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return self.run(Given(spark, folder))


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Run], Run]:
    """Register a function of the given tables under its own name."""

    def register(run: Run) -> Run:
        key = name or run.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = Query(key, run, sql)
        return run

    return register
