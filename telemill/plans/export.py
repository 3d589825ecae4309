"""Export of lake tables to Parquet with a provenance manifest."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MANIFEST = (
    "table string, source string, source_schema string, row_count bigint, snapshot_id bigint, "
    "output_file string, fallback_reason string, extracted_at string"
)

Source = Callable[[], DataFrame]


def readable_source(contract: Source, raw: Source, name: str) -> tuple[str, DataFrame, str | None]:
    """The contract source if it analyses, else the raw one with the reason, else an error.

    Only the schema is resolved; no data is read.
    """
    try:
        chosen = contract()
        chosen.schema
        return "contract", chosen, None
    except (AnalysisException, LookupError, ValueError) as exc:
        reason = f"contract source of {name} is not readable: {str(exc).splitlines()[0]}"
    try:
        fallback = raw()
        fallback.schema
    except (AnalysisException, LookupError, ValueError) as exc:
        raise RuntimeError(f"no readable source for {name}: {exc}") from exc
    return "lake", fallback, reason


def write_counted(df: DataFrame, target: str) -> int:
    """Write one dataset and return its row count, taken from the write itself."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("error").parquet(target)
    return seen.get["rows"]


def manifest(spark: SparkSession, rows: Iterable[tuple], extracted_at: datetime) -> DataFrame:
    """One row per exported table; the time is UTC text ending in ``Z``."""
    stamp = extracted_at.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    return spark.createDataFrame([(*row, stamp) for row in rows], MANIFEST)


def write_manifest(frame: DataFrame, target: str) -> None:
    """JSON, one object per table; an absent fallback reason leaves no field."""
    frame.coalesce(1).write.mode("error").json(f"{target}/manifest.json")
