"""A folder of probe dumps as a Spark data source: ``spark.read`` and ``spark.readStream`` of format ``probe_dumps``.

Rows are (epoch, path, line_no, line): the non-blank lines of each ``site-sonar-<epoch>.out.xz``. A reader
lists the folder itself and takes the files whose name hashes to its share, so that no file name passes
through the driver; it opens one file at a time and streams it as Arrow batches. A stream's offset is
the newest epoch: a batch holds the files above the last offset, and with it all files of an epoch at once.

Options: ``path``; ``after`` and ``upto`` bound the epochs of a batch read (exclusive, inclusive); ``readers``
is the number of shares.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from telemill.sources.dumps import DUMP_NAME, line_batches, open_file

FORMAT = "probe_dumps"
READERS, NONE, ALL = 64, -1, (1 << 62)


@dataclass
class Share(InputPartition):
    """Files of the folder with an epoch above ``after`` and up to ``upto`` whose name hashes to ``number``."""

    folder: str
    number: int
    shares: int
    after: int
    upto: int


def listed(folder: str) -> Iterator[tuple[int, str]]:
    """(epoch, url) of the dumps in a folder."""
    store, place = fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
    scheme = folder[: len(folder) - len(place)] if folder.endswith(place) else f"{folder.split(':')[0]}:" if ":" in folder else ""
    for info in store.get_file_info(fs.FileSelector(place, allow_not_found=True)):
        if info.is_file and (name := re.search(DUMP_NAME, info.path)):
            yield int(name[1]), f"{scheme}{info.path}"


def read_share(share: Share) -> Iterator[pa.RecordBatch]:
    for epoch, url in listed(share.folder):
        mine = zlib.crc32(url.rsplit("/", 1)[-1].encode()) % share.shares == share.number
        if mine and share.after < epoch <= share.upto:
            with open_file(url) as source:
                for batch in line_batches(source, url):
                    yield pa.RecordBatch.from_arrays([pa.array([epoch] * len(batch), pa.int64()), *batch.columns], ["epoch", *batch.schema.names])


class _Batch(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.folder, self.shares = options["path"], int(options.get("readers", READERS))
        self.after, self.upto = int(options.get("after", NONE)), int(options.get("upto", ALL))

    def partitions(self) -> list[Share]:
        return [Share(self.folder, k, self.shares, self.after, self.upto) for k in range(self.shares)]

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        return read_share(partition)


class _Stream(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.folder, self.shares = options["path"], int(options.get("readers", READERS))
        self.after = int(options.get("after", NONE))

    def initialOffset(self) -> dict:
        return {"epoch": self.after}

    def latestOffset(self) -> dict:
        return {"epoch": max((epoch for epoch, _ in listed(self.folder)), default=self.after)}

    def partitions(self, start: dict, end: dict) -> list[Share]:
        return [Share(self.folder, k, self.shares, start["epoch"], end["epoch"]) for k in range(self.shares)]

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        return read_share(partition)


class ProbeDumps(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "epoch bigint, path string, line_no bigint, line string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Batch(self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Stream(self.options)


def _options(spark: SparkSession, folder: str, **bounds: int | None) -> dict[str, str]:
    spark.dataSource.register(ProbeDumps)
    shares = max(READERS, 2 * spark.sparkContext.defaultParallelism)
    return {"path": folder, "readers": str(shares)} | {k: str(v) for k, v in bounds.items() if v is not None}


def dump_rows(spark: SparkSession, folder: str, after: int | None = None, upto: int | None = None) -> DataFrame:
    """The lines of a folder's dumps, of the epochs asked for."""
    return spark.read.format(FORMAT).options(**_options(spark, folder, after=after, upto=upto)).load()


def dump_stream(spark: SparkSession, folder: str, after: int | None = None) -> DataFrame:
    """The lines of a folder's dumps as a stream; the checkpoint keeps the newest epoch that was read."""
    return spark.readStream.format(FORMAT).options(**_options(spark, folder, after=after)).load()
