"""What a Python worker has computed for text segments, kept between Arrow batches.

Words repeat: a worker computes a segment once and looks it up afterwards. The memory is bounded:
a full store is emptied, and long segments are never kept. Results do not depend on it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import Generic, TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

V = TypeVar("V")
#: a longer text is cut at blanks or line feeds into pieces of about so many bytes
PIECE, BLANK = 4 << 20, re.compile("[ \n]")


class SegmentCache(Generic[V]):
    """Two generations of ``kept`` segments at most; what is asked for again moves to the younger."""

    def __init__(self, learn: Callable[[list[str]], list[V]], kept: int = 400_000, long: int = 256):
        self.learn, self.kept, self.long = learn, kept, long
        self.young: dict[str, V] = {}
        self.old: dict[str, V] = {}

    def look(self, cut: list[list[str]]) -> list[list[V]]:
        """The value of each segment of each text; no value is None."""
        get = self.young.get
        found = [list(map(get, segments)) for segments in cut]
        lacking = [i for i, values in enumerate(found) if None in values]
        if not lacking:
            return found
        asked = dict.fromkeys(s for i in lacking for s, v in zip(cut[i], found[i]) if v is None)
        old, fresh, new = self.old, {}, []
        for segment in asked:
            if (value := old.get(segment)) is None:
                new.append(segment)
            else:
                fresh[segment] = value
        fresh.update(zip(new, self.learn(new)))
        for i in lacking:
            values, segments = found[i], cut[i]
            at = -1
            try:
                while True:
                    at = values.index(None, at + 1)
                    values[at] = fresh[segments[at]]
            except ValueError:
                pass
        if len(self.young) + len(fresh) > self.kept:
            self.old, self.young = self.young, {}
        self.young.update((s, v) for s, v in fresh.items() if len(s) <= self.long)
        return found

    def look_once(self, segments: list[str]) -> list[V]:
        """The value of each of the segments, few of which repeat."""
        found = list(map(self.young.get, segments))
        if None not in found:
            return found
        lacking = [i for i, value in enumerate(found) if value is None]
        older = list(map(self.old.get, [segments[i] for i in lacking]))
        unknown = [segments[i] for i, value in zip(lacking, older) if value is None]
        learnt = iter(self.learn(unknown))
        if len(self.young) + len(lacking) > self.kept:
            self.old, self.young = self.young, {}
        young, long = self.young, self.long
        for i, value in zip(lacking, older):
            segment = segments[i]
            found[i] = value = next(learnt) if value is None else value
            if len(segment) <= long:
                young[segment] = value
        return found


def pieces(text: str) -> Iterator[str]:
    """Pieces of a long text that end before a blank or line feed."""
    at = 0
    while at < len(text):
        blank = BLANK.search(text, at + PIECE)
        end = blank.start() if blank else len(text)
        yield text[at:end]
        at = end


def ids_of_texts(cache: SegmentCache[bytes], texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts one after the other, and where those of each text begin and end.

    The cache gives the packed 32-bit ids of a stretch between blanks or line feeds. Arrow cuts the texts and
    finds the distinct stretches, so that Python sees each of them once a batch; ids are then gathered by arrays.
    """
    texts = pc.fill_null(texts, "")
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    if len(sizes) and sizes.max() > PIECE:
        cut = [[text] if len(text) <= PIECE else list(pieces(text)) for text in texts.to_pylist()]
        ids, bounds = _gathered(cache, pa.array([piece for parts in cut for piece in parts], pa.string()))
        return ids, bounds[np.cumsum([0, *map(len, cut)])]
    return _gathered(cache, texts)


def _gathered(cache: SegmentCache[bytes], texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or bounds[0] == bounds[-1]:
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    # a stretch ends behind a blank or a line feed, and where its text ends; its bytes stay where they are
    last = (data == 32) | (data == 10)
    last[bounds[1:][bounds[1:] > bounds[:-1]] - 1] = True
    cut = np.concatenate([[0], np.flatnonzero(last) + 1])
    stretches = pa.StringArray.from_buffers(len(cut) - 1, pa.py_buffer(cut.astype(np.int32)), pa.py_buffer(data))
    coded = stretches.dictionary_encode()
    found = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    packed = cache.look_once([s[:-1] if s[-1] in " \n" else s for s in found])
    sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
    stored, begins = np.frombuffer(b"".join(packed), "<i4"), np.cumsum(sizes) - sizes
    codes = coded.indices.to_numpy()
    counts = sizes[codes]
    ends = np.concatenate([[0], np.cumsum(counts)])
    # the place of an id among the stored ones: where its stretch begins there, and how far it is into it
    places = np.repeat(begins[codes] - ends[:-1], counts)
    places += np.arange(ends[-1])
    return stored[places], ends[np.searchsorted(cut, bounds)]
