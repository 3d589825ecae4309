"""Removal of repeated passages of three lines, found across all documents.

Lines are split at line feeds and compared without the blanks around them; lines without a word
are passed over, so a window is three consecutive lines that have words. The first occurrence of
a window, by doc_id and then position, stays; the lines that later occurrences cover go.

Defined results: a null text stays null and has no lines; a text with fewer than three lines with
words never changes; a row with a null doc_id never changes and is no first occurrence. Rows that
share a doc_id are one document, but each loses only lines under windows that it has itself, so equal
rows stay equal and another text of the id keeps its own lines. An empty table gives an empty table;
lines and texts of any length are taken whole; columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import free_name, let

BLANK = " \t\x0b\x0c\r"
SIZE = 3


def _lines(text: Column) -> Column:
    """struct(n, line) of each line with a word; n is its place in the text, from 0."""
    every = F.transform(F.split(text, "\n"), lambda line, n: F.struct(n.alias("n"), F.btrim(line, F.lit(BLANK)).alias("line")))
    return F.filter(every, lambda x: x["line"] != "")


def _windows(text: Column) -> Column:
    """struct(at, a, b) of each window: two hashes of its lines, from two seeds."""

    def windows(lines: Column) -> Column:
        def window(i: Column) -> Column:
            three = [F.get(lines, i + k)["line"] for k in range(SIZE)]
            hashes = F.xxhash64(*three), F.xxhash64(F.lit("second"), *three)
            return F.struct(i.alias("at"), hashes[0].alias("a"), hashes[1].alias("b"))

        starts = F.sequence(F.lit(0), F.size(lines) - SIZE)
        return F.when(F.size(lines) >= SIZE, F.transform(starts, window))

    return let(_lines(text), windows)


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, starts): where the later occurrences of windows begin, counted in lines with words, and their first hash.

    The first occurrence of a window is an aggregate that combines before the shuffle; the join
    with it is a plain one, so adaptive execution can split a window that very many texts hold.
    """
    found = docs.filter("doc_id IS NOT NULL").select("doc_id", F.explode(_windows(F.col("text"))).alias("w")).select("doc_id", "w.*")
    first = F.min(F.struct("doc_id", "at")).alias("first")
    again = found.groupBy("a", "b").agg(first, F.count("*").alias("n")).filter("n > 1").drop("n")
    later = found.join(again, ["a", "b"]).filter(F.struct("doc_id", "at") > F.col("first"))
    return later.groupBy("doc_id").agg(F.collect_set(F.struct("at", "a")).alias("starts"))


def _own(text: Column, starts: Column) -> Column:
    """Those of an id's starts whose window this text has there."""
    return let(_windows(text), lambda w: F.transform(F.filter(starts, lambda s: F.get(w, s["at"])["a"] == s["a"]), lambda s: s["at"]))


def _covered(starts: Column) -> Column:
    return F.array_distinct(F.flatten(F.transform(starts, lambda i: F.sequence(i, i + SIZE - 1))))


def _kept(text: Column, starts: Column) -> Column:
    def keep(lines: Column) -> Column:
        gone = F.transform(_covered(starts), lambda i: F.get(lines, i)["n"])
        whole = F.split(text, "\n")
        stay = lambda all_lines: F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), gone)
        return let(whole, lambda x: F.array_join(F.transform(stay(x), lambda n: F.get(x, n)), "\n"))

    return let(_lines(text), keep)


def dedup_lines(docs: DataFrame, count: str = "n_removed") -> DataFrame:
    """The documents with repeated passages removed, and the number of removed lines as ``count``.

    A column that already has that name is replaced.
    """
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    marked, starts = free_name(docs, "marked"), free_name(docs, "starts")
    marks = repeated_lines(texts).toDF(marked, starts)
    joined = docs.join(marks, F.col("doc_id") == F.col(marked), "left")
    joined = joined.withColumn(starts, F.when(F.col("text").isNotNull() & F.col(starts).isNotNull(), _own(F.col("text"), F.col(starts))))
    hit = F.col(starts).isNotNull() & (F.size(starts) > 0)
    removed = F.when(hit, F.size(_covered(F.col(starts)))).otherwise(0)
    text = F.when(hit, _kept(F.col("text"), F.col(starts))).otherwise(F.col("text"))
    return joined.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns if c != count], removed.cast("bigint").alias(count))
