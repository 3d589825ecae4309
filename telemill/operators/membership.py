"""A blocked Bloom filter as a table of 64-bit words, to leave out rows of a large side before an exact join.

A key sets some bits of one word, so the filter is one aggregate of the small side and one look-up for a row of the
large one, all of it in built-in functions. It is broadcast, behind a check of its size; for a small side beyond
that the large side goes to the join as it is. What the filter lets through by chance, the join settles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: keys that share a word on average, bits a key sets in its word, and words that may be broadcast (16 bytes each)
KEYS_A_WORD, BITS, MOST_WORDS = 4, 4, 4_000_000


def _place(key: str, words: int) -> tuple[Column, Column]:
    """The word of a key and the bits it sets there."""
    word = F.pmod(F.xxhash64(F.lit("word"), key), F.lit(words))
    mask = F.lit(0).cast("bigint")
    for k in range(BITS):
        bit = F.pmod(F.shiftright(F.xxhash64(F.lit("bits"), key), 8 * k), F.lit(64)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit))
    return word, mask


def bloom_words(keys: DataFrame, key: str, words: int) -> DataFrame:
    """(word, bits) of the filter."""
    word, mask = _place(key, words)
    return keys.filter(F.col(key).isNotNull()).select(word.alias("word"), mask.alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))


def pruned(large: DataFrame, small: DataFrame, key: str, most_words: int = MOST_WORDS) -> DataFrame:
    """Rows of the large side whose key may be on the small side; none that is there is left out."""
    words = small.agg(F.count(key)).first()[0] // KEYS_A_WORD + 1
    if words > most_words:
        return large
    # names of no column of the large side
    end = "_" * (1 + max((len(c) - len(c.rstrip("_")) for c in large.columns), default=0))
    at, asked, word, bits = (name + end for name in ("at", "asked", "word", "bits"))
    held = F.broadcast(bloom_words(small, key, words).toDF(word, bits))
    places = dict(zip((at, asked), _place(key, words)))
    same = (F.col(at) == F.col(word)) & (F.col(bits).bitwiseAND(F.col(asked)) == F.col(asked))
    return large.withColumns(places).join(held, same, "left_semi").select(*[F.col(f"`{c}`") for c in large.columns])


def presence_pruned(candidates: DataFrame, lake: DataFrame, most_words: int = MOST_WORDS) -> DataFrame:
    """(job_id, verified) as ``retention.presence`` gives it; lake keys that cannot match are not shuffled."""
    from telemill.operators.retention import presence

    return presence(candidates, pruned(lake.select("job_id"), candidates.select("job_id"), "job_id", most_words))
