"""Words of many texts at once, as 64-bit hashes in numpy arrays.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return, which is the same for UTF-8 bytes and for code points. A hash takes in a word's
length and then its bytes, eight at a time, through a bijection of 64-bit values that is not linear
in them, so that no words collide by their form; words of eight bytes or less collide only with
words of another length. Memory grows with the number of words, not with the lengths of texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: longer words are hashed one by one, the others in blocks of so many
LONG, BLOCK = 64, 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    out = x ^ (x >> np.uint64(30))
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    return out


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word of the bytes; eight bytes at least stand behind every word's start."""
    hashes = np.empty(len(starts), np.uint64)
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))  # the eight bytes from each place on
    for begin in range(0, len(starts), BLOCK):
        at, sizes = starts[begin : begin + BLOCK], ends[begin : begin + BLOCK] - starts[begin : begin + BLOCK]
        out = mix(sizes.astype(np.uint64) * BASE)
        todo, done = np.flatnonzero(sizes <= LONG), 0
        while len(todo):
            left = sizes[todo] - done
            unread = np.uint64(8) * (8 - np.minimum(left, 8)).astype(np.uint64)
            value = (eight[at[todo] + done] << unread) >> unread
            out[todo] = mix((out[todo] ^ value) + BASE)
            done += 8
            todo = todo[left > 8]
        for i in np.flatnonzero(sizes > LONG):
            out[i] ^= np.uint64(xxhash.xxh64_intdigest(data[at[i] : at[i] + sizes[i]]))
        hashes[begin : begin + BLOCK] = out
    return hashes


@dataclass
class Words:
    """hashes, byte starts and ends of all words; words of text i are offsets[i]:offsets[i + 1]."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray
    data: np.ndarray


def words_of(column: pa.Array) -> Words:
    texts = pc.fill_null(column, "").cast(pa.large_binary())
    ends_of = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    base = ends_of[0]
    ends_of = ends_of - base
    size = int(ends_of[-1])
    data = np.frombuffer(texts.buffers()[2], np.uint8)[base : base + size] if size else np.zeros(0, np.uint8)
    if not size:
        none = np.zeros(0, np.int64)
        return Words(none.astype(np.uint64), none, none, np.zeros(len(texts) + 1, np.int64), data)
    inside = ~SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = ends_of[:-1][ends_of[:-1] < size]
    begins[first] = inside[first]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    last = ends_of[1:][ends_of[1:] > 0] - 1
    closes[last] = inside[last]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    del begins, closes, inside
    behind = np.zeros(size + 8, np.uint8)
    behind[:size] = data
    return Words(_hashes(behind, starts, ends), starts, ends, np.searchsorted(starts, ends_of), data)


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` consecutive hashes; runs over text ends are included."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for i in range(size):
        total ^= total >> np.uint64(29)
        total *= BASE
        total += hashes[i : i + count]
    return mix(total)
