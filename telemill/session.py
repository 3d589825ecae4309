"""Session settings and the shared scratch folder.

The library never needs special session settings for right results, except a
UTC session time zone: naive and zoned timestamps are kept apart on purpose and
no cursor is ever cast between them.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app_name: str = "telemill", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the jobs are tuned for (UTC, adaptive plans)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # a repeated key in a probe document keeps its last value
        "spark.sql.variant.allowDuplicateKeys": "true",
    } | extra
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once a context: Python workers import it wherever they run.

    Only the driver sees the archive's folder; Spark sends the file.
    """
    context = spark.sparkContext
    if getattr(context, "_telemill_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="telemill-")) / "telemill.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._telemill_shipped = True


def is_local(spark: SparkSession) -> bool:
    return spark.conf.get("spark.master", "local").startswith("local")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session may fall back to a machine folder; a cluster without
    ``spark.checkpoint.dir`` is a configuration error.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if folder:
        return folder.rstrip("/")
    if not is_local(spark):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="telemill-")
    spark.conf.set(CHECKPOINT_KEY, folder)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused sub-folder name under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame computed once into the shared folder and read back: its lineage is cut there."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def observed(seen: Observation) -> dict[str, Any]:
    """What an observation saw; nothing where no row came and the adaptive plan left the observed step out."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


#: rows of one task of a compute-heavy step; a row may hold some ten kilobytes of text
TASK_ROWS = 50_000


def spread(df: DataFrame, key: str) -> DataFrame:
    """Work for all cores in tasks of bounded size, for a compute-heavy step over a scan of few or large splits.

    What a split holds is counted, which reads no column: the splits of a file are many, but a row group belongs to
    one of them, so most may be empty. An input that already has enough splits with few rows is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.groupBy(F.spark_partition_id().alias("split")).count()
    found = splits.agg(F.count("*").alias("splits"), F.max("count").alias("most"), F.sum("count").alias("rows")).first()
    if found.splits >= cores and found.most <= 2 * TASK_ROWS:
        return df
    return df.repartition(max(cores, -(-(found.rows or 0) // TASK_ROWS)), key)
