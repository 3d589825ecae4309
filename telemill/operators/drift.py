"""Schema checks: the evolve/freeze gate before a write, and contract drift.

Schemas are small frames (one row per column), so the checks are ordinary joins.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemill.contract import ContractTable
from telemill.functions.names import PREFIX

SCHEMA_ROWS = "table string, column string, type string"


class SchemaFrozenError(ValueError):
    """A column changed its type; only new columns may appear."""


class DriftError(ValueError):
    """The live schema lacks a column that a contract view selects."""


def schema_gate(current: T.StructType | None, incoming: T.StructType) -> T.StructType:
    """Evolve columns, freeze types. Returns the schema the table has afterwards."""
    if current is None:
        return incoming
    old = {field.name: field.dataType for field in current}
    changed = [
        f"{field.name}: {old[field.name].simpleString()} -> {field.dataType.simpleString()}"
        for field in incoming
        if field.name in old and old[field.name] != field.dataType
    ]
    if changed:
        raise SchemaFrozenError("column type changed: " + "; ".join(changed))
    added = [field for field in incoming if field.name not in old]
    return T.StructType(list(current) + added)


def schema_rows(df: DataFrame, table: str) -> DataFrame:
    """One (table, column, type) row per column of ``df``; analysis only, reads no data."""
    rows = [(table, field.name, field.dataType.simpleString()) for field in df.schema]
    return df.sparkSession.createDataFrame(rows, SCHEMA_ROWS)


def contract_rows(spark: SparkSession, tables: Iterable[ContractTable]) -> DataFrame:
    """(table, column, selected) for each column a contract knows."""
    rows = [
        (table.name, column, column in set(table.selected))
        for table in tables
        for column in sorted(table.known)
    ]
    return spark.createDataFrame(rows, "table string, column string, selected boolean")


def drift(live: DataFrame, contract: DataFrame) -> DataFrame:
    """(table, column, type, kind) of every difference between live and contract.

    ``additive``: a live ``jdl__`` column the contract does not know.
    ``informational``: any other unknown live column.
    ``subtractive``: a column the view selects that is not live.
    """
    served = F.broadcast(contract.select("table").distinct())
    both = (
        live.join(served, "table", "left_semi")
        .withColumn("_live", F.lit(True))
        .join(contract.withColumn("_known", F.lit(True)), ["table", "column"], "full_outer")
    )
    extra = F.when(F.col("column").startswith(PREFIX), "additive").otherwise("informational")
    kind = F.when(F.col("_known").isNull(), extra).when(
        F.col("_live").isNull() & F.col("selected"), "subtractive"
    )
    return both.select("table", "column", "type", kind.alias("kind")).filter("kind IS NOT NULL")


def drift_verdict(differences: DataFrame, strict: bool = False) -> DataFrame:
    """One row: counts per kind, whether views may be applied, and the exit code."""
    counts = differences.agg(
        F.count_if(F.col("kind") == "additive").alias("additive"),
        F.count_if(F.col("kind") == "informational").alias("informational"),
        F.count_if(F.col("kind") == "subtractive").alias("subtractive"),
    )
    blocked = F.col("subtractive") > 0
    fails = blocked | (F.lit(strict) & (F.col("additive") > 0))
    return counts.select(
        "*", (~blocked).alias("applied"), F.when(fails, 2).otherwise(0).alias("exit_code")
    )
