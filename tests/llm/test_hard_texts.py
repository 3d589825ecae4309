"""Texts that are crafted, very long or share an id."""

from __future__ import annotations

import subprocess
import sys
import textwrap
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from telemill.llm import line_dedup, ngram_join, quality, substring_dedup
from telemill.llm.queries import SQL
from telemill.llm.words import words_of


def folded(depth: int) -> tuple[str, str]:
    """Two words whose hashes meet if a hash is a sum of letters times powers modulo a power of two."""
    a, b = "a", "b"
    for _ in range(depth):
        a, b = a + b, b + a
    return a, b


def test_words_of_one_form_have_hashes_of_their_own():
    for depth in range(1, 12):
        a, b = folded(depth)
        hashes = words_of(pa.array([a, b, a + " " + b, b[:-1]])).hashes
        assert hashes[0] == hashes[2] and hashes[1] == hashes[3] and len(set(hashes.tolist())) == 3
    words = [w * k for w in "abé" for k in range(1, 200)] + ["".join(chr(97 + (i >> k & 1)) for k in range(12)) for i in range(4096)]
    assert len(set(words_of(pa.array([" ".join(words)])).hashes.tolist())) == len(set(words))
    hashes = words_of(pa.array(["xx" + w + "\ny" for w in words])).hashes
    assert np.array_equal(hashes[::2], words_of(pa.array([" ".join("xx" + w for w in words)])).hashes)


def test_substrings_of_crafted_words(spark, frame):
    a, b = folded(10)
    rest = " ".join(f"w{i}" for i in range(12))
    got = {r.doc_id: r.n_removed for r in substring_dedup.dedup_substrings(frame([(1, f"{a} {rest}"), (2, f"{b} {rest}"), (3, f"{a} {rest}")])).collect()}
    assert got == {1: 0, 2: 0, 3: 13}
    found = ngram_join.ngram_join(frame([(1, f"{a} x y z w"), (2, f"{b} x y z w")])).collect()
    assert [r.n_links for r in found] == [0, 0]


def test_line_windows_of_rows_that_share_an_id(spark, frame):
    passage, own = "x one\nx two\nx three\nx four", "own a\nown b\nown c\nown d"
    rows = line_dedup.dedup_lines(frame([(1, passage), (2, passage), (2, own), (2, passage), (3, None)])).collect()
    assert sorted((r.doc_id, r.n_removed, r.text or "") for r in rows) == [(1, 0, passage), (2, 0, own), (2, 4, ""), (2, 4, ""), (3, 0, "")]


@pytest.mark.parametrize("name", ["starts", "marked", "starts_", "_starts_", "_marked_id_", "w", "first"])
def test_line_windows_beside_a_column(spark, frame, name):
    docs = frame([(1, "a\nb\nc"), (2, "a\nb\nc")]).withColumn(name, F.lit("x"))
    rows = line_dedup.dedup_lines(docs).collect()
    assert sorted((r.doc_id, r.n_removed, r[name]) for r in rows) == [(1, 0, "x"), (2, 3, "x")]


@pytest.mark.parametrize("name", ["quality", "_quality_", "quality_"])
def test_clean_documents_beside_a_column(spark, frame, name):
    docs = frame([(1, " ".join(f"word{i}" for i in range(60)))]).withColumn(name, F.lit("x"))
    out = quality.clean_documents(docs)
    assert out.columns == docs.columns and out.first()[name] == "x"


#: (line, whether a rule removes it)
LINES = [
    ("home | menu", True), ("Log in", True), ("  About us » Contact -", True), ("home office", False), ("back to top", True), ("homemenu", False),
    ("Stop it!!", True), ("what?!(really)", False), ("what?! (really)", True), ("so?!) and", True), ("a!b!c", False), ("a!!b", False), ("!!a b!!", True),
    ("| a | b | c | d |", False), ("  | x | y | z | 1 |\r", False), ("One | Two | Three | Four | Five", True), ("a · b • c | d » e", True),
    ("cat a.log | grep 404 | sort | uniq -c | sort -rn | head", False), ("if (a | b | c | d | e) {", False),
    ("a long part of a sentence | another long part of it | and one more of them | a fourth one here | the end", False),
    ("foo### bar$$$ baz%%%", True), ("### one ### two ### three four", False), ("### ### ### end", True), ("a### b### three four five", False),
    ("####", True), ("Copyright 2024 Foo", True), ("© \t2024", True), ("(c) 2024", False), ("see the COPYRIGHT 2024", True), ("copyright in 2024", False), ("wait....", True), ("a.;", False),
    ("LOUD LINE WITH MANY CAPITALS IN it", True), ("LOUD line WITH more SMALL than CAPITALS", False), ("lorem IPSUM dolor", True), ("", False), (" \t", False),
]


def test_each_line_rule(spark):
    rows = spark.createDataFrame([(i, line) for i, (line, _) in enumerate(LINES)], "i int, line string")
    got = {r.i: r.f for r in rows.select("i", quality.line_fails(F.col("line"), quality.LineRules()).alias("f")).collect()}
    assert [(line, got[i]) for i, (line, _) in enumerate(LINES)] == LINES


def test_the_sql_states_the_rules(spark, frame):
    import duckdb

    filler = " ".join(f"word{i}" for i in range(60))
    documents = pa.table({"doc_id": range(len(LINES)), "text": [f"{line}\n{filler}\n{line}" for line, _ in LINES]})  # noqa: F841 - read by name
    want = duckdb.sql(SQL["op5_line_quality"]).fetchall()
    names = [d[0] for d in duckdb.sql(SQL["op5_line_quality"]).description]
    rows = quality.judged(frame([(i, f"{line}\n{filler}\n{line}") for i, (line, _) in enumerate(LINES)])).select("doc_id", "quality.*")
    assert sorted(tuple(r) for r in rows.select(names).collect()) == sorted(want)
    assert {r.doc_id: r.lost > 0 for r in rows.collect()} == {i: fails for i, (_, fails) in enumerate(LINES)}


def test_tables_pipelines_and_one_line_texts_stay(spark, frame):
    table = "\n".join(f"| cell {i} | value {i} | note | more |" for i in range(20))
    pipes = "\n".join(f"cat access.{i}.log | grep GET | cut -f 2 | sort | uniq -c | head" for i in range(12))
    prose = "a first part of some length | a second part of it | a third one of some words | " * 4 + "the end of it all"
    docs = frame([(1, table), (2, pipes), (3, prose)])
    assert {r.doc_id: r.quality.lost for r in quality.judged(docs).collect()} == {1: 0, 2: 0, 3: 0}


def test_lines_of_a_million_characters(spark, frame):
    made = ["home | ", "home - ", "!", "!!.", "a!", "[|»•·]", "|a", "###", "#a", "A", "Ab ", "© ", "copyright ", ".,", "é", "x" * 50 + "!"]
    docs = frame([(i, (part * (1_000_000 // len(part))) + tail) for i, part in enumerate(made) for tail in ("", "x")])
    started = time.time()
    assert quality.judged(docs.repartition(16)).filter("quality.word_chars > 0").count() == 2 * len(made)
    assert time.time() - started < 120


def test_memory_of_a_long_text():
    """The words of a text of 64 MB take less than a gigabyte."""
    code = """
        import resource
        import pyarrow as pa
        from telemill.llm.words import grams, words_of
        text = pa.array(["some words of a long text " * 2_500_000])
        before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
        grams(words_of(text).hashes, 5)
        print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
    """
    out = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], capture_output=True, text=True, check=True, cwd=line_dedup.__file__.rsplit("/", 3)[0])
    assert int(out.stdout) < 1000, out.stdout
