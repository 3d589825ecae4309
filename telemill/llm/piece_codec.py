"""SentencePiece encoding and decoding of merge-type vocabularies.

A text is cut before each run of word marks; no piece of the vocabulary crosses such a cut (this
is checked when the vocabulary is loaded). A segment is merged with a score-ordered agenda of
adjacent symbol pairs. Segments repeat, so each Python worker keeps what it has encoded, and each
Arrow batch checks its new segments against the sentencepiece library: a difference fails the task.

Defined results: a null text counts as the empty text, which has no ids; white space, control
characters and characters outside the vocabulary are encoded as the library does (byte pieces).
Rows are independent, so repeated rows, null ids and further columns change nothing.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import blocks, texts_of
from telemill.llm.segment_cache import SegmentCache

MARK = "▁"
SEGMENT = re.compile(f"{MARK}+[^{MARK}]*")
SHIFT, SHORT, GONE = 32, 48, -2
KEPT_PARTS = 250_000
NO_PLACE = 1 << 30


class PieceCodec:
    """The vocabulary of a model file, its merges, and what this worker has encoded with it."""

    def __init__(self, model: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        size = len(self.library)
        self.pieces = [self.library.id_to_piece(i) for i in range(size)]
        self.unknown = self.library.unk_id()
        self.control = {i for i in range(size) if self.library.is_control(i) or self.library.is_unknown(i)}
        self.byte_of = {i: int(self.pieces[i][3:5], 16) for i in range(size) if self.library.is_byte(i)}
        self.id_of_byte = {b: i for i, b in self.byte_of.items()}
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in self.control and i not in self.byte_of}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece crosses a word mark: texts cannot be cut there")
        self.joined = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.by_script = not any(a != MARK and a.isalpha() != b.isalpha() for a, b in self.joined)
        # letters with the marks before them, or what stands between letters; the pattern counts some numbers as letters
        numbers = "".join(sorted({c for p in self.ids for c in p if c.isalnum() and not c.isalpha() and not c.isdecimal()}))
        self.runs = re.compile(rf"{MARK}*[^\W\d_{numbers}]+|[\W\d_{numbers}]+")
        # equal scores share a place, so that the leftmost pair decides between them
        scores = {i: self.library.get_score(i) for i in self.ids.values()}
        places = {score: place for place, score in enumerate(sorted(set(scores.values()), reverse=True))}
        # a pair of neighbours is one number; it has a place on the agenda and makes a piece. The number
        # ``size`` stands for every character that is no piece: no pair holds it
        self.size, self.base = size, size + 1
        self.made = {
            self.ids[p[:i]] * self.base + self.ids[p[i:]]: k
            for p, k in self.ids.items()
            for i in range(1, len(p))
            if p[:i] in self.ids and p[i:] in self.ids
        }
        self.place = {pair: places[scores[k]] for pair, k in self.made.items()}
        self.cache: SegmentCache[tuple[str, str]] = SegmentCache(self.learn)
        self.decimal = [str(i) for i in range(size)]
        # tuples of numbers, which Python's collector need not visit
        self.parts: dict[str, tuple[int, ...]] = {}
        self.old_parts: dict[str, tuple[int, ...]] = {}

    def merge(self, text: str) -> list[int]:
        """Ids of one part: the best-scored adjacent pair merges first, of equal ones the leftmost.

        A character without a piece never merges and becomes its byte pieces.
        """
        ids, place, made_of, base, lone = self.ids, self.place.get, self.made, self.base, self.size
        symbols = [ids.get(c, lone) for c in text]
        if len(symbols) > SHORT:
            symbols = self._merge_long(symbols)
        else:
            # the agenda of a short part is one place per neighbour pair; index() finds the leftmost of the best
            agenda = [place(a * base + b, NO_PLACE) for a, b in zip(symbols, symbols[1:])]
            while agenda and (best := min(agenda)) != NO_PLACE:
                i = agenda.index(best)
                symbols[i] = made = made_of[symbols[i] * base + symbols.pop(i + 1)]
                del agenda[i]
                if i < len(agenda):
                    agenda[i] = place(made * base + symbols[i + 1], NO_PLACE)
                if i:
                    agenda[i - 1] = place(symbols[i - 1] * base + made, NO_PLACE)
        if lone not in symbols:
            return symbols
        single = iter([c for c in text if c not in ids])
        out: list[int] = []
        for symbol in symbols:
            out += [symbol] if symbol != lone else [self.id_of_byte.get(b, self.unknown) for b in next(single).encode()]
        return out

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """The same with a heap of (place, position) and linked neighbours, for long parts."""
        place, made_of, base, last = self.place.get, self.made, self.base, len(symbols) - 1
        before, after = list(range(-1, last)), [*range(1, last + 1), -1]
        first = ((place(symbols[i] * base + symbols[i + 1]), i) for i in range(last))
        agenda = [(found << SHIFT) | i for found, i in first if found is not None]
        heapq.heapify(agenda)
        while agenda:
            top = heapq.heappop(agenda)
            left = top & 0xFFFFFFFF
            right = after[left]
            if right < 0 or symbols[left] == GONE:
                continue
            pair = symbols[left] * base + symbols[right]
            if place(pair) != top >> SHIFT:
                continue
            symbols[left] = made = made_of[pair]
            symbols[right] = GONE
            after[left] = beyond = after[right]
            if beyond >= 0:
                before[beyond] = left
                if (found := place(made * base + symbols[beyond])) is not None:
                    heapq.heappush(agenda, (found << SHIFT) | left)
            ahead = before[left]
            if ahead >= 0 and (found := place(symbols[ahead] * base + made)) is not None:
                heapq.heappush(agenda, (found << SHIFT) | ahead)
        return [s for s in symbols if s != GONE]

    def cut(self, segment: str) -> list[str]:
        """Parts between neighbours that no piece holds together."""
        if self.by_script:
            return self.runs.findall(segment)
        at = [0, *(i for i in range(1, len(segment)) if segment[i - 1 : i + 1] not in self.joined), len(segment)]
        return [segment[a:b] for a, b in zip(at, at[1:])]

    def learn(self, segments: list[str]) -> list[tuple[str, str]]:
        """Ids, as text, of segments without their first mark, and what the ids decode to inside a text.

        The ids are checked against the library in one call.
        """
        truth = self.library.encode([s.replace(MARK, " ") for s in segments], num_threads=1)
        decimal, part_ids, out = self.decimal, self.part, []
        for segment, right in zip(segments, truth):
            marked = MARK + segment
            if self.by_script and segment.isalpha():
                ids = list(part_ids(marked))
            else:
                ids = [i for part in self.cut(marked) for i in part_ids(part)]
            # the library gives no ids for the empty text; its lone mark only stands inside a text
            if segment and ids != right:
                raise ValueError(f"{segment!r}: the agenda gives {ids}, the library {right}")
            out.append((",".join([decimal[i] for i in ids]), self.surface(ids)))
        return out

    def part(self, text: str) -> tuple[int, ...]:
        """Ids of a part, kept in two generations as segments are."""
        ids = self.parts.get(text)
        if ids is None:
            if (ids := self.old_parts.get(text)) is None:
                ids = tuple(self.merge(text))
            if len(text) <= self.cache.long:
                if len(self.parts) >= KEPT_PARTS:
                    self.old_parts, self.parts = self.parts, {}
                self.parts[text] = ids
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of a whole document's ids; the mark that begins a text is dropped."""
        text = self.surface(ids)
        return text[1:] if ids and self.pieces[ids[0]].startswith(MARK) else text

    def surface(self, ids: list[int]) -> str:
        text = "".join([self.pieces[i] for i in ids])
        if "<" in text:
            out, run = [], bytearray()
            for i in ids:
                if i in self.byte_of:
                    run.append(self.byte_of[i])
                    continue
                out.append(run.decode(errors="replace"))
                run.clear()
                out.append(" ⁇ " if i == self.unknown else "" if i in self.control else self.pieces[i])
            text = "".join(out) + run.decode(errors="replace")
        return text.replace(MARK, " ")

    def encode_batch(self, texts: list[str]) -> tuple[list[str], list[str]]:
        """Ids, as decimal numbers joined by commas, and decoded texts."""
        cut = []
        for text in texts:
            if not text:
                cut.append([])
            elif MARK in text or text[0] == " " or "  " in text:
                cut.append([s[1:] for s in SEGMENT.findall(MARK + text.replace(" ", MARK))])
            else:
                cut.append(text.split(" "))
        ids, decoded = [], []
        for values in self.cache.look(cut):
            of_text = ",".join([value[0] for value in values])
            # a segment holds whole characters, so the decoded segments joined are the decoded text
            text = "".join([value[1] for value in values])
            marked = of_text and self.pieces[int(of_text.split(",", 1)[0])].startswith(MARK)
            ids.append(of_text)
            decoded.append(text[1:] if marked else text)
        return ids, decoded


@lru_cache(maxsize=2)
def codec(model: str) -> PieceCodec:
    return PieceCodec(model)


def _encode(batches: Iterator[pa.RecordBatch], model: str, column: str, ids: str, decoded: str) -> Iterator[pa.RecordBatch]:
    worker = codec(model)
    for batch in blocks(batches, column):
        encoded, texts = worker.encode_batch(texts_of(batch, column))
        rest = [name for name in batch.schema.names if name != column]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name in rest), pa.array(encoded, pa.string()), pa.array(texts, pa.string())],
            [*rest, ids, decoded],
        )


def _decode(batches: Iterator[pa.RecordBatch], model: str, column: str, decoded: str) -> Iterator[pa.RecordBatch]:
    worker = codec(model)
    for batch in batches:
        texts = [None if ids is None else worker.decode(ids) for ids in batch.column(column).to_pylist()]
        yield batch.append_column(decoded, pa.array(texts, pa.string()))


def encode_texts(docs: DataFrame, model: str, column: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """The frame with ``column`` replaced by its ids, as decimal numbers joined by commas, and their decoded text.

    Decimal text keeps a long document's ids in one flat buffer; ``ids_of`` makes an array of it.
    Columns that already have the new names are replaced.
    """
    rest = [f for f in docs.schema if f.name not in (column, ids, decoded)]
    kept = docs.select(*[F.col(f"`{f.name}`") for f in rest], F.col(column).cast("string").alias(column))
    schema = docs.select(*[F.col(f"`{f.name}`") for f in rest], F.lit("").alias(ids), F.lit("").alias(decoded)).schema
    return kept.mapInArrow(partial(_encode, model=model, column=column, ids=ids, decoded=decoded), schema)


def ids_of(ids: str) -> Column:
    """An array of the ids of ``encode_texts``; the empty text has none."""
    return F.when(F.col(ids) == "", F.array().cast("array<int>")).otherwise(F.split(ids, ",").cast("array<int>"))


def decode_ids(frame: DataFrame, model: str, column: str = "ids", decoded: str = "decoded") -> DataFrame:
    """The frame with the decoded text of an array column of ids, in place of a column of that name; null ids give null."""
    frame = frame.drop(decoded)
    schema = frame.withColumn(decoded, F.lit(None).cast("string")).schema
    return frame.mapInArrow(partial(_decode, model=model, column=column, decoded=decoded), schema)
