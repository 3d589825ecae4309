"""Probe dump files: listing, choice of new files, and the compressed JSON-lines reader."""

from __future__ import annotations

import lzma
from collections.abc import Iterator
from typing import Protocol

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed pattern: a dump link in a directory listing, and its generation time.
DUMP_LINK = r'href="([^"]*?site-sonar-(\d+)\.out\.xz)"'
DUMP_NAME = r"site-sonar-(\d+)\.out\.xz$"

_CHUNK, _READ = 1 << 22, 1 << 20
# bytes of a stream's header: less than that cannot be told from padding or trailing bytes
_HEADER = 12
_BATCH_BYTES = 16 << 20
_LINES = "path string, line_no bigint, line string"


def resolve_link(base_url: Column, href: Column) -> Column:
    """Absolute links as they are, root-relative on the host, others below the base."""
    origin = F.regexp_extract(base_url, r"^[^:/?#]+://[^/?#]*", 0)
    return (
        F.when(href.startswith("http://") | href.startswith("https://"), href)
        .when(href.startswith("/"), F.concat(origin, href))
        .otherwise(F.concat(F.rtrim(base_url, F.lit("/")), F.lit("/"), href))
    )


def links(pages: DataFrame, url: str, html: str, pattern: str = DUMP_LINK) -> DataFrame:
    """One row per matching link: the page's url, position, href and resolved url.

    ``pattern``'s first group is the href. Other links in the page are ignored.
    """
    found = F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1))
    exploded = pages.select(F.col(url).alias("base_url"), F.posexplode(found).alias("pos", "href"))
    return exploded.withColumn("link", resolve_link(F.col("base_url"), F.col("href")))


def list_dumps(pages: DataFrame, url: str = "base_url", html: str = "html") -> DataFrame:
    """(epoch, url) of every dump a listing page links to."""
    epoch = F.regexp_extract("href", DUMP_NAME, 1).cast("bigint")
    return links(pages, url, html).select(epoch.alias("epoch"), F.col("link").alias("url"))


def dump_files(spark: SparkSession, folder: str) -> DataFrame:
    """(epoch, url) of the dumps in a folder on shared storage; reads no content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.out.xz").load(folder)
    epoch = F.regexp_extract("path", DUMP_NAME, 1)
    return files.filter(epoch != "").select(
        epoch.cast("bigint").alias("epoch"), F.col("path").alias("url")
    )


def newer_than(files: DataFrame, mark: int) -> DataFrame:
    """Files with an epoch strictly above the high-water mark."""
    return files.filter(F.col("epoch") > F.lit(mark))


def take_files(files: DataFrame, limit: int | None = None, order: str = "oldest") -> DataFrame:
    """The next files to read, in whole epochs: files of the epoch that the limit reaches come along.

    ``oldest`` never skips a file. ``newest`` moves the mark past older files that
    the limit left out, which are then never read.
    """
    by = F.col("epoch").desc() if order == "newest" else F.col("epoch").asc()
    ordered = files.orderBy(by, "url")
    if limit is None:
        return ordered
    reached = ordered.limit(limit).agg((F.min if order == "newest" else F.max)("epoch").alias("epoch")).scalar()
    return ordered.filter(F.col("epoch") >= reached if order == "newest" else F.col("epoch") <= reached)


class _Source(Protocol):
    def read(self, size: int) -> bytes: ...


def _decoded(source: _Source, path: str) -> Iterator[bytes]:
    """Decompressed chunks of one xz file, which may hold several streams; reads it step by step."""
    rest, first = b"", True
    while True:
        while len(rest) < _HEADER and (more := source.read(_READ)):
            rest += more
            rest = rest if first else rest.lstrip(b"\0")  # stream padding
        if not rest and not first:
            return
        decoder, begun = lzma.LZMADecompressor(), False
        while not decoder.eof:
            try:
                chunk = decoder.decompress(rest, max_length=_CHUNK)
            except lzma.LZMAError:
                if first or begun:
                    raise
                return  # bytes after the last whole stream that start no new one
            begun, rest = True, b""
            if chunk:
                yield chunk
            if decoder.needs_input and not decoder.eof and not (rest := source.read(_READ)):
                raise lzma.LZMAError(f"truncated dump {path}")
        rest, first = decoder.unused_data.lstrip(b"\0"), False


def _file_lines(source: _Source, path: str) -> Iterator[tuple[int, str]]:
    number, rest = 0, b""
    for chunk in _decoded(source, path):
        *whole, rest = (rest + chunk).split(b"\n")
        for raw in whole:
            number += 1
            yield number, raw.decode("utf-8", "replace").strip()
    if rest:
        yield number + 1, rest.decode("utf-8", "replace").strip()


def line_batches(source: _Source, path: str) -> Iterator[pa.RecordBatch]:
    """(path, line_no, line) of the non-blank lines of one open file, some megabytes at a time."""
    schema = pa.schema([("path", pa.string()), ("line_no", pa.int64()), ("line", pa.string())])
    numbers: list[int] = []
    texts: list[str] = []
    size = 0
    for number, text in _file_lines(source, path):
        if not text:
            continue
        numbers.append(number)
        texts.append(text)
        size += len(text)
        if size >= _BATCH_BYTES:
            yield _lines_batch(path, numbers, texts, schema)
            numbers, texts, size = [], [], 0
    if texts:
        yield _lines_batch(path, numbers, texts, schema)


def _read_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            # the file's bytes stay where Arrow holds them
            yield from line_batches(pa.BufferReader(content.as_buffer()), path.as_py())


def open_file(url: str) -> pa.NativeFile:
    """A stored file as a stream, wherever Arrow's file systems reach."""
    store, place = fs.FileSystem.from_uri(url if "://" in url or url.startswith("file:") else f"file://{url}")
    return store.open_input_stream(place, compression=None)


def _open_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for url in batch.column("url"):
            with open_file(url.as_py()) as source:
                yield from line_batches(source, url.as_py())


def _lines_batch(path: str, numbers: list[int], texts: list[str], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"path": [path] * len(texts), "line_no": numbers, "line": texts}, schema=schema
    )


def dump_lines(files: DataFrame) -> DataFrame:
    """(path, line_no, line) of the non-blank lines of xz files given as (path, content).

    A file is decompressed step by step, so memory holds one compressed file and
    one batch of lines. A truncated or unreadable file fails the job.
    """
    return files.select("path", "content").mapInArrow(_read_lines, _LINES)


def stored_lines(files: DataFrame, tasks: int) -> DataFrame:
    """(path, line_no, line) of stored dumps given as (epoch, url); their names stay on the executors.

    Each task opens its files one after the other and streams them, so it holds a chunk and a batch of lines.
    """
    return files.select("url").repartition(tasks, "url").mapInArrow(_open_lines, _LINES)


def probe_rows(lines: DataFrame) -> DataFrame:
    """Lines that hold a JSON object, as probe rows; malformed lines are left out.

    ``test_results_json`` changes shape between hosts and stays a variant.
    """
    parsed = lines.withColumn("_doc", F.try_parse_json("line"))
    is_object = F.schema_of_variant("_doc").startswith("OBJECT")

    def field(name: str, kind: str):
        return F.try_variant_get("_doc", f"$.{name}", kind).alias(name)

    return parsed.filter(is_object).select(
        field("host_id", "bigint"),
        field("hostname", "string"),
        field("ce_name", "string"),
        field("addr", "string"),
        field("last_updated", "bigint"),
        field("test_results_json", "variant"),
    )


def line_report(lines: DataFrame) -> DataFrame:
    """(path, lines, good, skipped) per file."""
    doc = F.try_parse_json("line")
    good = F.coalesce(F.schema_of_variant(doc).startswith("OBJECT"), F.lit(False))
    return lines.groupBy("path").agg(
        F.count("*").alias("lines"),
        F.count_if(good).alias("good"),
        F.count_if(~good).alias("skipped"),
    )


def next_mark(files: DataFrame, mark: int) -> DataFrame:
    """One row: the mark after all of ``files`` were read; never lowered."""
    return files.agg(F.greatest(F.lit(mark).cast("bigint"), F.max("epoch")).alias("mark"))


def test_children(probes: DataFrame, list_path: str) -> DataFrame:
    """Child rows of a list inside the test results: (hostname, last_updated, idx, value)."""
    items = F.variant_get("test_results_json", list_path, "array<string>")
    return probes.select("hostname", "last_updated", F.posexplode(items).alias("idx", "value"))
