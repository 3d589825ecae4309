"""Benchmark decontamination by pigeonhole: exact pieces, then bit-parallel edit distance.

A test item that may differ by e edits is cut into e + 1 pieces; in any text within e edits of it
one piece stands unchanged. An automaton finds all pieces of a block of items in one pass over a
text, and Myers' algorithm verifies the surroundings of each hit.

Texts and items are compared in lower case with white space collapsed. Defined results: a null or
word-free text or item matches nothing; items with equal texts are all reported; the documents are
searched whole, and rows are independent, so repeated rows and null doc_ids are reported as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegerType, StructField, StructType

from telemill.llm.common import blocks, texts_of, written

#: one edit for so many characters of an item
CHARS_AN_EDIT = 20
#: characters of items that one pass over the documents searches for
BLOCK_CHARS = 8_000_000


def plain(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str) -> list[tuple[int, str]]:
    """(offset, piece) of the error budget plus one pieces of about equal length."""
    count = len(item) // CHARS_AN_EDIT + 1
    cuts = [len(item) * k // count for k in range(count + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def best_distance(item: str, text: str, most: int) -> int:
    """The least edit distance of the item to any substring of the text, or most + 1 if it is larger."""
    peq: dict[str, int] = {}
    for i, char in enumerate(item):
        peq[char] = peq.get(char, 0) | (1 << i)
    mask, high = (1 << len(item)) - 1, 1 << (len(item) - 1)
    up, down, score, best = mask, 0, len(item), min(len(item), most + 1)
    for char in text:
        eq = peq.get(char, 0)
        same = ((((eq & up) + up) ^ up) | eq | down) & mask
        rise, fall = down | (~(same | up) & mask), up & same
        if rise & high:
            score += 1
        elif fall & high:
            score -= 1
        # a match may begin anywhere: the row above the item stays at zero
        rise, fall = (rise << 1) & mask, (fall << 1) & mask
        up, down = fall | (~(same | rise) & mask), rise & same
        if score < best:
            best = score
            if not best:
                break
    return best


class Searcher:
    """An automaton of the pieces of some items."""

    def __init__(self, items: list[tuple[object, str]]):
        import ahocorasick

        self.items = items
        by_piece: dict[str, list[tuple[int, int]]] = {}
        for k, (_, item) in enumerate(items):
            for offset, piece in pieces(item):
                by_piece.setdefault(piece, []).append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in by_piece.items():
            self.automaton.add_word(piece, (len(piece), owners))
        self.automaton.make_automaton()

    def search(self, text: str) -> dict[int, int]:
        """Least distance of each item, by its place, that stands in the text within its budget."""
        found: dict[int, int] = {}
        done: dict[int, int] = {}
        for end, (size, owners) in self.automaton.iter(text):
            for k, offset in owners:
                item = self.items[k][1]
                budget = len(item) // CHARS_AN_EDIT
                begin = end + 1 - size - offset
                if found.get(k) == 0 or done.get(k) == begin:
                    continue  # another piece of the same place
                done[k] = begin
                if begin >= 0 and text.startswith(item, begin):
                    found[k] = 0
                    continue
                around = text[max(0, begin - budget) : begin + len(item) + budget]
                distance = best_distance(item, around, budget)
                if distance <= budget:
                    found[k] = min(distance, found.get(k, distance))
        return found


#: the block a worker searches for at present; one is held at a time
_HELD: dict[str, Searcher] = {}


def searcher_of(block: str, items: list[tuple[object, str]]) -> Searcher:
    """The automaton of a block, built once a worker."""
    if block not in _HELD:
        _HELD.clear()
        _HELD[block] = Searcher(items)
    return _HELD[block]


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[object, str]]]:
    """The items that have text, in blocks of at most BLOCK_CHARS characters (a longer item is alone).

    The items are a stated query set; the driver and a task hold one block of them, and the driver the next one.
    """
    items, size = [], 0
    for row in benchmark.select("item_id", F.col("text").cast("string").alias("text")).toLocalIterator():
        text = plain(row.text)
        if items and size + len(text) > BLOCK_CHARS:
            yield items
            items, size = [], 0
        if text:
            items.append((row.item_id, text))
            size += len(text)
    if items:
        yield items


def find_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, distance) of each test item that a document holds within the item's budget.

    One pass over the documents for each block of items, and no shuffle. Of several blocks each is searched for by
    a job of its own that stores what it finds, so that neither the driver nor a plan ever holds two.
    """
    types = [to_arrow_type(docs.schema["doc_id"].dataType), to_arrow_type(benchmark.schema["item_id"].dataType)]
    schema = StructType([docs.schema["doc_id"], benchmark.schema["item_id"], StructField("distance", IntegerType())])
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def passed(items: list[tuple[object, str]]) -> DataFrame:
        block = uuid.uuid4().hex

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            searcher = searcher_of(block, items)
            for batch in blocks(batches):
                at, ids, distances = [], [], []
                for row, text in enumerate(texts_of(batch)):
                    for k, distance in searcher.search(plain(text)).items():
                        at.append(row)
                        ids.append(items[k][0])
                        distances.append(distance)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(at, pa.int64())), pa.array(ids, types[1]), pa.array(distances, pa.int32())],
                    schema.names,
                )

        return texts.mapInArrow(search, schema)

    waiting, found = None, []
    for items in item_blocks(benchmark):
        if waiting is not None:
            found.append(written(passed(waiting), "found-items"))
        waiting = items
    if waiting is None:
        return docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, [*found, passed(waiting)])


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no test item, judged in passes over the texts without a shuffle.

    What a block of items leaves is stored before the next block is looked at.
    """

    def without(items: list[tuple[object, str]]):
        block = uuid.uuid4().hex

        def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            searcher = searcher_of(block, items)
            for batch in blocks(batches):
                yield batch.filter(pa.array([not searcher.search(plain(text)) for text in texts_of(batch)], pa.bool_()))

        return drop

    waiting = None
    for items in item_blocks(benchmark):
        if waiting is not None:
            docs = written(docs.mapInArrow(without(waiting), docs.schema), "clean-documents")
        waiting = items
    return docs if waiting is None else docs.mapInArrow(without(waiting), docs.schema)
