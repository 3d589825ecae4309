"""The pipeline against brute force on small documents, stage by stage."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from telemill.llm.common import written
from test_ngram_join import brute

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def documents():
    r = random.Random(21)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(3, 8)))
    line = lambda: (" ".join(word() for _ in range(12)) + ".").capitalize()
    more = lambda: "\n".join(line() for _ in range(6))
    clean = ["\n".join(line() for _ in range(8)) for _ in range(30)]
    item = " ".join(word() for _ in range(20))
    passage = "\n".join(line() for _ in range(3))
    rows = [(i, text) for i, text in enumerate(clean)]
    near = clean[0].split(" ")
    near[40] = "changed"
    joined = " ".join(near).replace("\n", " ")
    rows += [(100, clean[0].replace("\n", " ")), (101, joined), (102, clean[1] + "\n" + item), (103, passage + "\n" + more())]
    rows += [(104, more() + "\n" + passage), (105, None), (106, ""), (107, "too short"), (108, clean[2].upper().replace(" ", "!! "))]
    return rows, item, passage


@pytest.fixture
def folder(spark, frame, tmp_path):
    rows, item, _ = documents()
    frame(rows).withColumn("row", F.lit(1)).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stages(spark, folder):
    rows, item, passage = documents()
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, folder), "test")
        seen[name] = {r[0]: r for r in docs.collect()}
        assert docs.columns == columns or name == corpus_pipeline.STAGES[-1][0]
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert set(seen[names[0]]) == set(range(30)) | {100, 101, 102, 103, 104}
    lines = seen[names[1]]
    # the passage goes from its second document, and the first lines of a document that begins with another
    assert passage in lines[103].text and passage not in lines[104].text
    assert set(seen[names[0]]) - set(lines) == set() and lines[102].text == item
    assert all(r.n_chars == len(r.text) for r in lines.values())
    classes = brute([(i, r.text) for i, r in lines.items()])
    assert set(seen[names[2]]) == {i for i, (least, _, _) in classes.items() if least == i}
    assert not {100, 101} & set(seen[names[2]])
    assert set(seen[names[2]]) - set(seen[names[3]]) == {102}
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for i, r in seen[names[4]].items():
        text = seen[names[3]][i].text
        assert r.ids == library.encode(text) and r.n_tokens == len(r.ids) and r.decoded == text
    whole = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert whole == seen[names[4]]


def test_empty_and_null_rows(spark, frame, folder):
    text = "\n".join(" ".join(f"w{chr(97 + i)}{chr(97 + k)}" for k in range(10)) + "." for i in range(9))
    for rows, left in (([], 0), ([(None, text), (None, None), (1, text), (1, text)], 2)):
        docs = frame(rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, folder), "test")
        assert docs.count() == left
