"""Per-key row choice and load lineage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_text(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """A text that identifies the row's values: used only to hash or to break ties."""
    wanted = columns or df.columns
    fields = {field.name: field.dataType for field in df.schema}
    parts = [
        F.to_json(F.col(name)).alias(name) if isinstance(fields[name], T.VariantType) else F.col(name)
        for name in wanted
    ]
    return F.to_json(F.struct(*parts))


def _sortable(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    plain = not isinstance(kind, (T.MapType, T.VariantType, T.ArrayType, T.StructType))
    return F.col(name) if plain else F.to_json(F.col(name))


def latest_per_key(df: DataFrame, key: str = "job_id", cursor: str | None = None) -> DataFrame:
    """One row per key: the highest cursor, ties broken by the row's other values.

    Spark keeps only the first row of each key on the map side before it shuffles
    (window group limit), so a key that holds a large share of the rows costs one
    row per input partition. The tie columns are compared only where there is a tie.
    """
    ties = [_sortable(df, name) for name in df.columns if name not in (key, cursor)]
    order = [F.col(cursor).desc_nulls_last()] if cursor and cursor != key else []
    ranked = Window.partitionBy(key).orderBy(*order, *(ties or [F.lit(0)]))
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def with_lineage(df: DataFrame, load_id: str, key: str | None = None) -> DataFrame:
    """Add the load id and a row id that is the same on every replay of the load.

    The row id hashes the whole row, or only ``key`` where that names a row.
    """
    identity = F.col(key).cast("string") if key else row_text(df)
    row_id = F.sha2(F.concat_ws("|", F.lit(load_id), identity), 256)
    return df.withColumns({"_dlt_load_id": F.lit(load_id), "_dlt_id": row_id})
