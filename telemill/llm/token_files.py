"""Token ids as Parquet list columns, in document order, with offsets into the whole id stream.

The writer range-partitions by doc_id and sorts, so the files follow each other in ascending
doc_id order. Ids are one list column in dictionary encoding (ids repeat), document offsets and
sizes are plain columns of the same rows; small row groups and the page index that Parquet's
writer adds let a reader take single documents, or the metadata without any ids.

Defined results: a null text counts as the empty text and still gets the end id; a null doc_id sorts
first; rows that share a doc_id follow each other. An empty table gives an empty table.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemill.llm.common import blocks
from telemill.llm.segment_cache import SegmentCache, ids_of_texts

#: a word of letters that normalisation only lowers, and the plain punctuation behind it
SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!\"#$%&()*+,\-./:;=?@\[\\\]^_`{}~]*)")
ROW_GROUP, PAGE, BLOCK, KEPT = 16 << 20, 256 << 10, 4 << 20, 300_000


class WordEncoder:
    """Ids of texts by the tokenizers library, kept for each stretch between blanks.

    The tokenizer replaces white space by a blank and drops it before its merges, so ids never
    depend on what stands beyond a blank.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        self.letter = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}
        self.packed = [i.to_bytes(4, "little") for i in range(self.library.get_vocab_size() + 1)]
        self.words: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}
        self.stretches: SegmentCache[bytes] = SegmentCache(self.learn, kept=KEPT)

    def _word(self, word: str) -> bytes:
        spelled = word if word.isascii() else "".join([self.letter[b] for b in word.encode()])
        ids = b"".join([self.packed[t.id] for t in self.model.tokenize(spelled)])
        if len(self.words) >= KEPT:
            self.words.clear()
        if len(word) <= self.stretches.long:
            self.words[word] = ids
        return ids

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, stretches: list[str]) -> list[bytes]:
        """Ids of stretches: a word and the marks behind it apart, all others as the library's whole encoding."""
        marks, words, word = self.marks, self.words, self._word
        out, other, behind = [], [], []
        for stretch in stretches:
            if stretch.isascii() and stretch.isalpha():
                lower = stretch.lower()
                out.append(words.get(lower) or word(lower))
            elif found := SIMPLE.fullmatch(stretch):
                lower, tail = found[1].lower(), found[2]
                ids = words.get(lower) or word(lower)
                if (after := marks.get(tail)) is None:
                    behind.append((len(out), tail))
                    after = b""
                out.append(ids + after)
            else:
                other.append((len(out), stretch))
                out.append(b"")
        if behind:
            marks.update(zip(tails := list({tail for _, tail in behind}), self._whole(tails)))
            for at, tail in behind:
                out[at] += marks[tail]
        if other:
            for (at, _), ids in zip(other, self._whole([stretch for _, stretch in other])):
                out[at] = ids
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _encode(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """Rows in the order they come, with their offset among the ids of this partition."""
    worker, at = encoder(path), 0
    for batch in blocks(batches, most=BLOCK):
        ids, bounds = ids_of_texts(worker.stretches, batch.column("text"))
        values = np.insert(ids, bounds[1:], end_id)
        offsets = bounds + np.arange(len(bounds))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(at + offsets[:-1]),
                pa.array(np.diff(offsets)),
                pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, pa.int32())),
            ],
            ["doc_id", "start_in_part", "n_tokens", "ids"],
        )
        at += int(offsets[-1])


def write_tokens(docs: DataFrame, target: str, tokenizer: str, end_id: int) -> None:
    """Write (part, doc_id, start_in_part, n_tokens, ids) files in ascending doc_id order."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    ordered = texts.repartitionByRange(F.col("doc_id")).sortWithinPartitions("doc_id")
    schema = f"doc_id {kind}, start_in_part bigint, n_tokens bigint, ids array<int>"
    encoded = ordered.mapInArrow(partial(_encode, path=tokenizer, end_id=end_id), schema)
    options = {
        "compression": "zstd",
        "parquet.block.size": ROW_GROUP,
        "parquet.page.size": PAGE,
        "parquet.enable.dictionary": "true",
        "parquet.dictionary.page.size": 1 << 20,
    }
    encoded.withColumn("part", F.spark_partition_id()).write.options(**options).parquet(target)


def token_index(spark: SparkSession, target: str) -> DataFrame:
    """(doc_id, part, start_in_part, start, n_tokens) of the files; the ids are not read.

    ``start`` counts the ids of all documents before this one: the sum over whole parts, one row
    each, and the offset within the part that the writer kept.
    """
    return _placed(spark, target).select("doc_id", "part", "start_in_part", "start", "n_tokens")


def _placed(spark: SparkSession, target: str) -> DataFrame:
    stored = spark.read.parquet(target)
    totals = stored.groupBy("part").agg(F.sum("n_tokens")).collect()  # one row a part
    offsets, before = [], 0
    for part, total in sorted(tuple(row) for row in totals):
        offsets.append((part, before))
        before += total
    # one row of two numbers for each task that wrote: small however many documents there are
    placed = stored.join(F.broadcast(spark.createDataFrame(offsets, "part int, before bigint")), "part")
    return placed.withColumn("start", F.col("before") + F.col("start_in_part"))


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        values = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), dtype="<u4")
        bounds = ids.offsets.to_numpy()
        crc = [zlib.crc32(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
        rest = [name for name in batch.schema.names if name != "ids"]
        yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in rest), pa.array(crc, pa.int64())], [*rest, "ids_crc32"])


def read_tokens(spark: SparkSession, target: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files."""
    return _placed(spark, target).select("doc_id", "start", "n_tokens", "ids")


def with_checksum(tokens: DataFrame) -> DataFrame:
    """The frame with its ids replaced by the crc32 of their little-endian 32-bit values."""
    kept = tokens.drop("ids")
    return tokens.select(*kept.columns, "ids").mapInArrow(_crc, kept.withColumn("ids_crc32", F.lit(0).cast("bigint")).schema)
