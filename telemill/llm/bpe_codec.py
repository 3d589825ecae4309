"""Byte-pair encoding by backtracking over longest matches, and decoding with an offset table.

An Aho-Corasick automaton of the vocabulary gives the longest token at each place of a word. The
encoder takes it if it is compatible with the token before it, else the next shorter one that starts
there, else it steps back; a place it left is never entered again, so the work is linear in the
word. Two neighbours are compatible if merging their symbols apart never has a merge across the
seam that comes first; the answers are kept in a table. Tokens that are pairwise compatible are the
one result that the merges in rank order give.

Normalisation makes white space one blank and the word pattern drops it, so a text is cut at
blanks and line feeds and each stretch is encoded by itself; a worker keeps what it has encoded.

Defined results: a null text counts as the empty text, which has no ids; the strings of special
tokens in a text become their ids, as the tokenizers library does by default. Rows are independent,
so repeated rows, null ids and further columns change nothing; columns that already have the new
names are replaced. An empty table gives an empty table. A very long text is encoded in pieces of
about four million characters that end at blanks.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache, partial

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import blocks
from telemill.llm.segment_cache import SegmentCache, ids_of_texts

NEVER, BASE = 1 << 60, -1
KEPT_WORDS, KEPT_PAIRS, BLOCK = 300_000, 1_000_000, 4 << 20
#: the end of a word; no byte is spelled as it
END = "\n"
#: stretches that normalisation only lowers, and the words of them once lowered
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]*")
PLAIN_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


class MergeTable:
    """A vocabulary with ranked merges: longest matches, shorter prefixes and compatible neighbours."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        spelled = {t: t[: -len(suffix)] + END if suffix and t.endswith(suffix) else t for t in vocab}
        self.size = max(vocab.values()) + 1
        self.text = {i: spelled[t] for t, i in vocab.items()}
        self.rank: dict[int, int] = {}
        self.born, self.parts = [BASE] * self.size, [(0, 0)] * self.size
        for rank, (a, b) in enumerate(merges):
            left, right, made = vocab[a], vocab[b], vocab[a + b]
            self.rank[left * self.size + right] = rank
            self.born[made], self.parts[made] = rank, (left, right)
        ordered = all(max(self.born[vocab[a]], self.born[vocab[b]]) < rank for rank, (a, b) in enumerate(merges))
        if not ordered or len({a + b for a, b in merges}) < len(merges):
            raise ValueError("a token has two merges, or one before those of its parts")
        # a token that merging its own text does not give never stands in a result
        real: dict[int, bool] = {}
        for token in sorted(self.text, key=self.born.__getitem__):
            a, b = self.parts[token]
            real[token] = self.born[token] == BASE or (real[a] and real[b] and self.apart(a, b, self.born[token]))
        self.token = {t: i for i, t in self.text.items() if real[i]}
        self.length = [0] * self.size
        self.shorter = [BASE] * self.size
        self.matches = ahocorasick.Automaton()
        for text, token in self.token.items():
            self.length[token] = len(text)
            self.matches.add_word(text, token)
            self.shorter[token] = next((self.token[text[:k]] for k in range(len(text) - 1, 0, -1) if text[:k] in self.token), BASE)
        self.matches.make_automaton()
        self.pairs: dict[int, bool] = {}

    def apart(self, a: int, b: int, until: int = NEVER) -> bool:
        """No merge of rank below ``until`` joins the two across their seam.

        Both are taken apart, the latest merge first. Two symbols at the seam stand there until the
        one or the other is merged into a larger one; of equal ranks the left merge comes first.
        """
        born, parts, rank, size = self.born, self.parts, self.rank.get, self.size
        a_ends = b_ends = until
        while True:
            joined = rank(a * size + b)
            if joined is not None and joined < a_ends and joined <= b_ends:
                return False
            if born[a] > born[b]:
                a_ends, a = born[a], parts[a][1]
            elif born[b] != BASE:
                b_ends, b = born[b], parts[b][0]
            else:
                return True

    def compatible(self, pair: int) -> bool:
        """The entry of the pair table for ``left * size + right``."""
        if len(self.pairs) >= KEPT_PAIRS:
            self.pairs.clear()
        known = self.pairs[pair] = self.apart(*divmod(pair, self.size))
        return known

    def encode(self, word: str) -> list[int]:
        """Ids of a spelled word, ``END`` included where the vocabulary marks word ends."""
        if (whole := self.token.get(word)) is not None:
            return [whole]
        length, shorter, known, size, end = self.length, self.shorter, self.pairs.get, self.size, len(word)
        longest = [BASE] * (end + 1)
        for last, token in self.matches.iter(word):  # later matches of a start are longer
            longest[last + 1 - length[token]] = token
        left_behind = bytearray(end + 1)
        out: list[int] = []
        at, before, token = 0, BASE, longest[0]
        while at < end:
            while token != BASE:
                if not left_behind[at + length[token]]:
                    if before == BASE:
                        break
                    fits = known(pair := before * size + token)
                    if fits or (fits is None and self.compatible(pair)):
                        break
                token = shorter[token]
            if token != BASE:
                out.append(token)
                at += length[token]
                before, token = token, longest[at]
            else:
                if not out:
                    raise ValueError(f"no tokens for {word[:40]!r}")
                left_behind[at] = 1
                last = out.pop()
                at -= length[last]
                before, token = out[-1] if out else BASE, shorter[last]
        return out


class BpeCodec:
    """One tokenizer file, and what this worker has encoded with it."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)  # only its normaliser and word pattern are used
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        model = given["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        suffix = model["end_of_word_suffix"] or ""
        self.table = MergeTable(model["vocab"], merges, suffix)
        self.end = END if suffix else ""
        added = {a["content"]: a["id"] for a in given["added_tokens"]}
        if any(a["normalized"] or a["lstrip"] or a["rstrip"] or a["single_word"] for a in given["added_tokens"]):
            raise ValueError("only special tokens that are found as they stand")
        self.special = added
        self.special_parts = re.compile("|".join(f"({re.escape(s)})" for s in sorted(added, key=len, reverse=True)) or "(?!)")
        # how the byte alphabet spells each byte: printable ones as themselves
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.letter = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        self.packed = [i.to_bytes(4, "little") for i in range(self.table.size + len(added))]
        self.words: dict[str, bytes] = {}
        self.stretches: SegmentCache[bytes] = SegmentCache(lambda new: [self.stretch(s) for s in new], kept=300_000)
        # the offset table: where each id's string begins in one block of all strings
        strings = {i: t for t, i in (model["vocab"] | added).items()}
        self.surface = pa.array([strings.get(i, "") for i in range(len(self.packed))], pa.string())
        self.decimal = pa.array([str(i) for i in range(len(self.packed))], pa.string())

    def spelled(self, word: str) -> bytes:
        """Packed ids of a word in the byte alphabet."""
        if (ids := self.words.get(word)) is None:
            ids = b"".join([self.packed[i] for i in self.table.encode(word + self.end)])
            if len(self.words) >= KEPT_WORDS:
                self.words.clear()
            if len(word) <= self.stretches.long:
                self.words[word] = ids
        return ids

    def stretch(self, text: str) -> bytes:
        """Packed ids of a text without blanks."""
        if text.isalpha() and text.isascii():
            return self.spelled(text.lower())
        if PLAIN.fullmatch(text) and "<|" not in text:
            words = PLAIN_WORD.findall(text.lower())
            if not text.isascii():
                words = ["".join([self.letter[b] for b in w.encode()]) for w in words]
            return b"".join(map(self.spelled, words))
        out, at = [], 0
        for found in self.special_parts.finditer(text):
            out += [self._general(text[at : found.start()]), self.packed[self.special[found[0]]]]
            at = found.end()
        return b"".join([*out, self._general(text[at:])])

    def _general(self, text: str) -> bytes:
        if not text:
            return b""
        words = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return b"".join([self.spelled(word) for word, _ in words])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where those of each text begin and end."""
        return ids_of_texts(self.stretches, texts)


@lru_cache(maxsize=2)
def codec(path: str) -> BpeCodec:
    return BpeCodec(path)


def _joined(strings: pa.Array, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The strings of each row's ids with a blank between them."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), strings.take(pa.array(ids))), " ")


def _encode(batches: Iterator[pa.RecordBatch], path: str, column: str, new: tuple[str, str, str]) -> Iterator[pa.RecordBatch]:
    worker = codec(path)
    for batch in blocks(batches, column, BLOCK):
        ids, offsets = worker.encode(batch.column(column))
        offsets = offsets.astype(np.int32)
        made = [pa.array(np.diff(offsets).astype(np.int64)), _joined(worker.decimal, ids, offsets), _joined(worker.surface, ids, offsets)]
        rest = [name for name in batch.schema.names if name != column]
        yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in rest), *made], [*rest, *new])


def _decode(batches: Iterator[pa.RecordBatch], path: str, column: str, decoded: str) -> Iterator[pa.RecordBatch]:
    worker = codec(path)
    for batch in batches:
        texts = []
        for ids in batch.column(column):  # a null stays null
            texts.append(pc.binary_join(pa.scalar(worker.surface.take(ids.values).to_pylist(), pa.list_(pa.string())), " ").as_py() if ids.is_valid else None)
        yield batch.append_column(decoded, pa.array(texts, pa.string()))


def encode_texts(
    docs: DataFrame, path: str, column: str = "text", n_tokens: str = "n_tokens", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """The frame with ``column`` replaced by the number of ids, the ids (decimal, a blank between), and what they decode to.

    The decoded text is taken from the ids by the offset table: the strings of the ids with a blank
    between them, which is how the library decodes a file without a decoder.
    """
    new = (n_tokens, ids, decoded)
    rest = [F.col(f"`{f.name}`") for f in docs.schema if f.name not in (column, *new)]
    kept = docs.select(*rest, F.col(column).cast("string").alias(column))
    schema = docs.select(*rest, F.lit(0).cast("bigint").alias(n_tokens), F.lit("").alias(ids), F.lit("").alias(decoded)).schema
    return kept.mapInArrow(partial(_encode, path=path, column=column, new=new), schema)


def decode_ids(frame: DataFrame, path: str, column: str = "ids", decoded: str = "decoded") -> DataFrame:
    """The frame with the decoded text of an array column of ids, in place of a column of that name; null ids give null."""
    frame = frame.drop(decoded).withColumn(column, F.col(column).cast("array<int>"))
    return frame.mapInArrow(partial(_decode, path=path, column=column, decoded=decoded), frame.withColumn(decoded, F.lit(None).cast("string")).schema)
