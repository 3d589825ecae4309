"""Removal of word passages that an earlier document holds, by seed and extend.

Seeds: of the 5-word runs in each 13-word window the one with the least hash is the window's anchor,
so two documents that share a window share its anchor. Documents are joined on anchors through
an aggregate; only anchors of two documents or more go on. Extension: around a shared anchor the
match must reach 13 words to the left and right together, which each window that holds the anchor
tests by a hash of all its words. A window goes if a document with a smaller id has it, and the
union of such windows gives the maximal repeats.

No pair of documents is formed, a hot anchor or window is combined before its shuffle, and the
joins with the aggregates are plain ones that adaptive execution can split.

Defined results: a null text has no words; a text with fewer than 13 words never changes; a row with
a null doc_id never changes and is no source. Rows that share a doc_id are one document: none of
them is a source for the others.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import blocks, texts_of, written
from telemill.llm.words import grams, words_of

WINDOW, SEED = 13, 5


def anchors_of(hashes: np.ndarray) -> np.ndarray:
    """The least seed hash in each window, by doubling the reach of a running minimum."""
    least = seeds = grams(hashes, SEED)
    reach, whole = 1, WINDOW - SEED + 1
    while reach < whole:
        step = min(reach, whole - reach)
        least = np.minimum(least[: len(least) - step], least[step:])
        reach += step
    return least[: max(0, len(seeds) - whole + 1)]


def _places(offsets: np.ndarray) -> list[tuple[int, int, int]]:
    """(text, first window, last window + 1) of each text that has a window."""
    return [(i, a, b - WINDOW + 1) for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])) if b - a >= WINDOW]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches):
        words = words_of(batch.column("text"))
        least = anchors_of(words.hashes)
        found = [(i, np.unique(least[a:b])) for i, a, b in _places(words.offsets)]
        rows = np.repeat([i for i, _ in found], [len(u) for _, u in found]).astype(np.int64)
        every = np.concatenate([u for _, u in found]) if found else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows)), pa.array(every.view(np.int64))], ["doc_id", "anchor"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the windows that hold a shared anchor, once a document."""
    for batch in blocks(batches):
        words = words_of(batch.column("text"))
        least, whole = anchors_of(words.hashes), grams(words.hashes, WINDOW)
        shared, bounds = _lists(batch.column("anchors"))
        rows, anchors, windows = [], [], []
        for i, a, b in _places(words.offsets):
            at = a + np.flatnonzero(np.isin(least[a:b], shared[bounds[i] : bounds[i + 1]]))
            window, first = np.unique(whole[at], return_index=True)
            # windows of an anchor stand together, so that the anchor column takes little room
            order = np.argsort(least[at][first], kind="stable")
            rows.append(np.full(len(window), i))
            anchors.append(least[at][first][order])
            windows.append(window[order])
        if rows:
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(np.concatenate(rows))),
                    pa.array(np.concatenate(anchors).view(np.int64)),
                    pa.array(np.concatenate(windows).view(np.int64)),
                ],
                ["doc_id", "anchor", "window"],
            )


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values, as unsigned hashes, and bounds of a list column; a null list is empty."""
    sizes = np.array([0 if n is None else n for n in column.value_lengths().to_pylist()], np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.concatenate([[0], np.cumsum(sizes)])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches):
        words = words_of(batch.column("text"))
        whole = grams(words.hashes, WINDOW)
        gone, bounds = _lists(batch.column("windows"))
        texts = texts_of(batch)
        counts = np.diff(words.offsets)
        removed, kept, spans = np.zeros(len(texts), np.int64), [], []
        last = dict((i, (a, b)) for i, a, b in _places(words.offsets))
        for i, text in enumerate(texts):
            parts = text.encode().split()
            found = []
            if bounds[i] < bounds[i + 1] and i in last:
                a, b = last[i]
                hit = np.isin(whole[a:b], gone[bounds[i] : bounds[i + 1]])
                edge = np.zeros(counts[i] + 1, np.int64)
                edge[:-WINDOW] += hit
                edge[WINDOW:] -= hit
                covered = np.cumsum(edge[:-1]) > 0
                change = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
                found = [{"start": int(s), "end": int(e)} for s, e in zip(change[::2], change[1::2])]
                removed[i] = covered.sum()
                parts = list(compress(parts, ~covered))
            kept.append(b" ".join(parts).decode())
            spans.append(found)
        rest = [name for name in batch.schema.names if name not in ("text", "windows")]
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in rest), pa.array(counts), pa.array(removed), pa.array(kept, pa.string()), pa.array(spans, span)],
            [*rest, "n_words", "n_removed", "kept_text", "repeats"],
        )


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, repeats) of each row of (doc_id, text).

    ``kept_text`` are the words that stay, joined by one blank; ``repeats`` the removed maximal
    runs as word positions, end exclusive.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = texts.filter("doc_id IS NOT NULL")
    seeds = known.mapInArrow(_anchors, "doc_id bigint, anchor bigint")
    shared = seeds.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    of_doc = seeds.join(shared, "anchor").groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors"))
    of_doc = written(of_doc, "anchors")

    windows = known.join(of_doc, "doc_id").select("doc_id", "text", "anchors").mapInArrow(_windows, "doc_id bigint, anchor bigint, window bigint")
    windows = written(windows, "windows")
    first = windows.groupBy("anchor", "window").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    first = written(first.drop("last"), "first")
    later = windows.join(first, ["anchor", "window"]).filter("doc_id > first")
    gone = written(later.groupBy("doc_id").agg(F.collect_set("window").alias("windows")), "repeats")

    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, repeats array<struct<start:bigint,end:bigint>>"
    return texts.join(gone, "doc_id", "left").select("doc_id", "text", "windows").mapInArrow(_cut, schema)
