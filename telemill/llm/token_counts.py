"""Token counts of a unigram vocabulary by a Viterbi pass that keeps only score and count.

An automaton of all pieces enumerates the vocabulary matches that end at each character; per end
the best score and its number of pieces are kept, no path. The rules are those of the tokenizers
library's Unigram model: pieces are taken between word marks; of equal scores the longest piece
ending there wins; a character that is no piece costs ten less than the least score, and what
stays unknown counts its UTF-8 bytes where the vocabulary has byte pieces, else one for a run.

Defined results: a null text counts as the empty text, which has no tokens; rows are independent, so
repeated rows, null ids and further columns change nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import blocks, texts_of
from telemill.llm.segment_cache import SegmentCache

MARK = "▁"
PENALTY = 10.0
BYTE = re.compile("<0x[0-9A-F]{2}>")


class UnigramCounter:
    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick

        self.unknown = min(score for _, score in vocabulary) - PENALTY
        self.bytes = len({piece for piece, _ in vocabulary if BYTE.fullmatch(piece)}) == 256
        self.single = {piece for piece, _ in vocabulary if len(piece) == 1}
        # of a piece that occurs twice the last one counts, as in the library
        self.automaton = ahocorasick.Automaton()
        for piece, score in dict(vocabulary).items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.cache: SegmentCache[int] = SegmentCache(lambda segments: [self.count(MARK + s) for s in segments])

    def count(self, segment: str) -> int:
        """The number of tokens of a segment's best path."""
        size = len(segment)
        score: list[float | None] = [0.0] + [None] * size
        pieces, known = [0] * (size + 1), [True] * (size + 1)
        matches: list[list[tuple[int, float]]] = [[] for _ in range(size + 1)]
        for end, match in self.automaton.iter(segment):
            matches[end + 1].append(match)
        for end in range(1, size + 1):
            best, count, sure = None, 0, True
            for length, gain in sorted(matches[end], reverse=True):
                begin = end - length
                if (so_far := score[begin]) is not None and (best is None or so_far + gain > best):
                    best, count, sure = so_far + gain, pieces[begin] + 1, True
            char = segment[end - 1]
            if char not in self.single and (so_far := score[end - 1]) is not None:
                if best is None or so_far + self.unknown > best:
                    best, sure = so_far + self.unknown, False
                    # neighbours that are unknown make one token unless they are written as bytes
                    joined = not known[end - 1] and end > 1
                    count = pieces[end - 1] + (len(char.encode()) if self.bytes else 0 if joined else 1)
            score[end], pieces[end], known[end] = best, count, sure
        return pieces[size]

    def count_batch(self, texts: list[str]) -> list[int]:
        cut = []
        for text in texts:
            text = text.replace(" ", MARK)
            cut.append((text[1:] if text[0] == MARK else text).split(MARK) if text else [])
        return [sum(counts) for counts in self.cache.look(cut)]


def vocabulary_of(model: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file, in the order of their ids."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=model)
    return [(library.id_to_piece(i), library.get_score(i)) for i in range(len(library))]


@lru_cache(maxsize=2)
def counter(model: str) -> UnigramCounter:
    return UnigramCounter(vocabulary_of(model))


def _count(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[pa.RecordBatch]:
    worker = counter(model)
    for batch in blocks(batches):
        rest = [name for name in batch.schema.names if name != "text"]
        counts = pa.array(worker.count_batch(texts_of(batch)), pa.int64())
        yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in rest), counts], [*rest, "n_tokens"])


def count_tokens(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens) of each row of (doc_id, text), in one pass without a shuffle."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(partial(_count, model=model), f"doc_id {kind}, n_tokens bigint")
