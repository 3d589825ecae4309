"""What the operators share: tables written once, column helpers, blocks of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemill.session import scratch

BATCH_KEY, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def small_batches(spark: SparkSession) -> None:
    """Whole texts are long rows: fewer of them in an Arrow batch keep tasks and Python workers small."""
    if not 0 < int(spark.conf.get(BATCH_KEY)) <= BATCH_ROWS:
        spark.conf.set(BATCH_KEY, BATCH_ROWS)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame computed once into the shared folder and read back.

    Its lineage is cut there, so a lost executor costs only the running step. The shuffle
    files of the step go as soon as the table is written.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    small_batches(spark)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """The name, with as many marks behind it as make it differ from every column of the frame."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that the texts of one take about ``most`` bytes; a longer text comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return ["" if text is None else text for text in batch.column(column).to_pylist()]
