"""Spelling variants: words one edit apart, and the frequent word that each is a form of.

Asymmetric chunks find the pairs. A word gives its two halves as chunks; the words that it is joined
with give the grams of those lengths at the places a chunk may have in them. One edit leaves a half
as it is, at its place if the edit is behind it and shifted by the difference of the lengths if it is
before it. The half that holds the edit is split the same way once more, so that a join key is about
three quarters of a word and its length; however many words there are, those of one key differ in a
quarter only. Pairs that meet are verified by their edit distance. Of two words the shorter, or of
equal length the lesser, gives the chunks.

Words are counted in each task before they are shuffled, so a word may stand anywhere any number of
times. Forms lead to words of at least twice the number, so a chain of them is short; its end is
found by doubling, one join a round.

Defined results: a null text has no words, a null doc_id counts as the empty string; repeated rows
count as often as they stand there; of equally frequent near words the least by code points is the
form. Further columns are not read. An empty table gives an empty table. A very long text is counted in
pieces of about a million characters that end beside a word.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import blocks, written

RUN, BESIDE = re.compile("[a-zÀ-ÿ]+"), re.compile("[^a-zÀ-ÿ]")
SHORTEST, FEWEST, HELD, PIECE = 5, 3, 200_000, 1 << 20


def _runs(text: str) -> Counter[str]:
    """How often each run of letters stands in a text that is in lower case."""
    if len(text) <= PIECE:
        return Counter(RUN.findall(text))
    found, at = Counter(), 0
    while at < len(text):
        beside = BESIDE.search(text, at + PIECE)
        end = beside.start() if beside else len(text)
        found.update(RUN.findall(text[at:end]))
        at = end
    return found


def _count(batches: Iterator[pa.RecordBatch], drop_every: int) -> Iterator[pa.RecordBatch]:
    held: dict[str, int] = {}

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held, pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

    for batch in blocks(batches):
        # only A-Z are lowered
        texts = pc.ascii_lower(pc.fill_null(batch.column("text"), "")).to_pylist()
        for doc, text in zip(batch.column("doc").to_pylist(), texts):
            prefix = zlib.crc32(f"{doc}:".encode())
            for word, n in _runs(text).items():
                if len(word) < SHORTEST:
                    continue
                if drop_every and (h := zlib.crc32(word.encode(), prefix)) % drop_every == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1 :]
                    if len(word) < SHORTEST:
                        continue
                held[word] = held.get(word, 0) + n
            if len(held) >= HELD:
                yield out()
                held = {}
    if held:
        yield out()


def count_words(docs: DataFrame, drop_every: int = 0, fewest: int = FEWEST) -> DataFrame:
    """(word, n) of the words of at least five letters that stand at least ``fewest`` times in all texts.

    With ``drop_every``, a run loses a letter where that number divides the crc32 of
    ``<doc_id>:<run>``: the letter whose place is the crc32 modulo the run's length.
    """
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.col("text").cast("string").alias("text"))
    counted = texts.mapInArrow(partial(_count, drop_every=drop_every), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= fewest)


def _keys(length: Column, longer: int) -> Column:
    """The join keys of ``word`` as, or to meet, a word of ``length``: all of it but one of four quarters.

    ``longer`` is 1 for the grams of a word that has one letter more: what stands behind the
    quarter with the edit is shifted by one.
    """
    half = F.expr("length div 2")
    ends = [F.expr("length div 2 div 2"), half, half + F.expr("(length - length div 2) div 2"), length]
    word, begins = F.col("word"), [F.lit(0), *ends[:-1]]
    keys = []
    for quarter, (begin, end) in enumerate(zip(begins, ends)):
        before = F.substring(word, F.lit(1), begin)
        behind = F.substring(word, end + (1 + longer), length)
        keys.append(F.xxhash64(length, F.lit(quarter), before, behind))
    return F.array(*keys)


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): each pair of distinct words one edit apart, once; the shorter or lesser first."""
    sized = words.select("word", "n", F.length("word").alias("length"))
    own = sized.select("word", "n", F.explode(_keys(F.col("length"), 0)).alias("key"))
    meet = sized.withColumn("length", F.col("length") - 1).filter(F.col("length") >= SHORTEST)
    meet = meet.select("word", "n", F.explode(_keys(F.col("length"), 1)).alias("key"))
    grams = own.unionByName(meet).select("key", F.col("word").alias("near"), F.col("n").alias("near_n"))
    longer = F.length("near") > F.length("word")
    met = own.join(grams, "key").filter(longer | (F.col("word") < F.col("near")))
    one_edit = F.levenshtein("word", "near", 1) == 1
    return met.filter(one_edit).drop("key").dropDuplicates(["word", "near"])


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms of each word that has one end."""
    now = written(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = written(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variant-roots")
        if not now.agg(F.max("moved")).first()[0]:
            return now.drop("moved")
        now = now.drop("moved")


def variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each of the distinct (word, n).

    A word's form is its most frequent near word, if that stands at least twice as often.
    """
    words = written(words, "variant-words")
    pairs = written(near_pairs(words), "variant-pairs")
    back = pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    first = F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("first")
    near = pairs.unionByName(back).groupBy("word", "n").agg(F.count("*").alias("n_near"), first)
    enough = -F.col("first.rank") >= 2 * F.col("n")
    near = near.select("word", "n_near", F.when(enough, F.col("first.near")).alias("form"), F.when(enough, -F.col("first.rank")).alias("form_n"))
    near = written(near, "variant-forms")
    roots = _roots(near.filter("form IS NOT NULL"))
    out = words.join(near, "word", "left").join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n")
