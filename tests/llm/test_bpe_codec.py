from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from telemill.llm.bpe_codec import BpeCodec, MergeTable, decode_ids, encode_texts
from telemill.llm.queries import QUERIES
from telemill.llm.segment_cache import PIECE

PATH = public_tokenizers.path("word_bpe_49k.json")
BITS = (
    "a b ab the Th É é ß İ Σ ΣΣ 1 2² ½ ª µ 's 'LL ’s 日 本 😀 👍🏽 <|endoftext|> <|startoftext|> <| |> </w> × ÷ !! ... - _ ﬁ K 한 aaaa ing"
).split() + ["é", "̧", " ", "\n", "\t", " ", "\u0085", " ", "\x1c", "\x00", "‍"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def merged(word: str, merges: list[tuple[str, str]]) -> list[str]:
    """The definition: of the neighbours that a merge joins, the first merge in the list, leftmost, until none is left."""
    rank, parts = {m: r for r, m in enumerate(merges)}, list(word)
    while True:
        best = min(((rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in rank), default=None)
        if best is None:
            return parts
        parts[best[1] : best[1] + 2] = ["".join(parts[best[1] : best[1] + 2])]


def test_backtracking_equals_merging_for_random_vocabularies():
    r = random.Random(5)
    for _ in range(60):
        vocab, merges = {c: i for i, c in enumerate("abc")}, []
        while len(merges) < 25:
            a, b = r.choice(list(vocab)), r.choice(list(vocab))
            if a + b not in vocab and len(a + b) <= 8:
                vocab[a + b] = len(vocab)
                merges.append((a, b))
        table, text = MergeTable(vocab, merges), {i: t for t, i in vocab.items()}
        for _ in range(200):
            word = "".join(r.choice("abc" if r.random() < 0.7 else "a") for _ in range(r.randint(1, 30)))
            assert [text[i] for i in table.encode(word)] == merged(word, merges)


def test_a_vocabulary_that_merges_cannot_rank_is_refused():
    with pytest.raises(ValueError):
        MergeTable({"a": 0, "b": 1, "ab": 2, "aba": 3}, [("ab", "a"), ("a", "b")])


def test_equals_the_library(spark, frame, library):
    r = random.Random(2)
    texts = ["", " ", "a" * 5000, "ab" * 4000, "Don't DON'T it's 3.14", *BITS]
    texts += ["".join(r.choice(BITS) for _ in range(r.randint(0, 25))) for _ in range(4000)]
    texts += ["".join(r.choice("etaoin shrdlu") for _ in range(r.randint(0, 60))) for _ in range(1000)]
    out = encode_texts(frame(list(enumerate(texts))), PATH).withColumn("list", F.split("ids", " "))
    rows = decode_ids(out.withColumn("list", F.when(F.col("ids") != "", F.col("list"))), PATH, "list", "again").collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (row.n_tokens, row.ids, row.decoded) == (len(ids), " ".join(map(str, ids)), decoded), texts[row.doc_id]
        assert row.again == (decoded if ids else None)


def test_given_documents_equal_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op11_bpe_codec"](spark, folder).collect()}
    for doc, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert got.pop(doc) == (len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False)))
    assert not got


def test_long_texts_are_cut_at_blanks():
    worker, part = BpeCodec(PATH), "Größe, one two\nthree "
    times = 2 * PIECE // len(part) + 100
    once, _ = worker.encode(pa.array([part]))
    ids, bounds = worker.encode(pa.array([part * times, None, "one", "", "one " * 3]))
    assert bounds.tolist() == [0, times * len(once), times * len(once), times * len(once) + 1, times * len(once) + 1, len(ids)]
    assert np.array_equal(ids[: bounds[1]], np.tile(once, times)) and ids[bounds[1] :].tolist() == worker.encode(pa.array(["one"]))[0].tolist() * 4
    ids, bounds = worker.encode(pa.array([], pa.string()))
    assert len(ids) == 0 and bounds.tolist() == [0]


def test_nulls_repeats_clashing_names_and_empty_table(spark, frame):
    assert encode_texts(frame([]), PATH).count() == 0
    docs = frame([(None, None), (1, "a b"), (1, "a b")]).withColumns({n: F.lit("x") for n in ("ids", "decoded", "n_tokens", "column")})
    out = encode_texts(docs, PATH)
    assert sorted(out.columns) == sorted(set(docs.columns) - {"text"})
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids, r.decoded, r.column) for r in out.collect()) == [
        (0, 0, "", "", "x"), (1, 2, "320 321", "a</w> b</w>", "x"), (1, 2, "320 321", "a</w> b</w>", "x"),
    ]
