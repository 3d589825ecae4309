from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from telemill.llm.queries import QUERIES
from telemill.llm.spelling_variants import PIECE, count_words, variants

COLUMNS = "word form root n n_near form_n".split()


def plain_counts(docs, drop_every=0):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if drop_every and h % drop_every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}


def plain_variants(words):
    """Near words share a word with one letter out, or become equal by one deletion."""
    by_hole, near = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            by_hole[w[:i] + "\0" + w[i + 1 :]].add(w)
            if (shorter := w[:i] + w[i + 1 :]) in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in by_hole.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def got(frame):
    rows = frame.select(COLUMNS).collect()
    assert len(rows) == len(set(rows))
    return {tuple(r) for r in rows}


def test_random_words_equal_brute_force(spark):
    r = random.Random(6)
    words = {}
    for letters, length, many in [("ab", 9, 900), ("abcé", 6, 900), ("aé", 16, 300)]:
        for _ in range(many):
            words["".join(r.choice(letters) for _ in range(r.randint(5, length)))] = r.choice([3, 4, 8, 20, 100, 1000])
    words |= {"a" * k: 3 * k for k in range(5, 40)} | {"ab" * k: k for k in range(3, 20)}
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert got(variants(frame)) == plain_variants(words)


def test_long_chains_of_forms_reach_their_root(spark):
    words = {"abcdefgh" + "x" * k: 3 << (40 - k) for k in range(40)}
    rows = got(variants(spark.createDataFrame(list(words.items()), "word string, n bigint")))
    assert {r[2] for r in rows} == {"abcdefgh"} and rows == plain_variants(words)


def test_counts_equal_brute_force(spark, frame):
    r = random.Random(9)
    bits = ["Hello", "WORLD", "straße", "ÀÉÎ", "naïve", "it's", "×÷×÷×", "日本語", "x", "abcde", "hello", "-", "\n", "ÿÿÿÿÿ", "İstanbul", "co-op"]
    docs = [(r.choice([None, *range(40)]), " ".join(r.choice(bits) for _ in range(r.randint(0, 60)))) for _ in range(400)]
    docs += [(1, None), (2, ""), (3, docs[0][1]), (3, docs[0][1])]
    for every in (0, 97, 3):
        rows = count_words(frame(docs), drop_every=every).collect()
        assert len(rows) == len({w.word for w in rows}) and {w.word: w.n for w in rows} == plain_counts(docs, every)


def test_long_texts_are_cut_beside_words(spark, frame):
    docs = [(1, "longword " * (PIECE // 4)), (2, "y" * (PIECE + 9)), (3, "y" * (PIECE + 9)), (4, "y" * (PIECE + 9))]
    rows = {w.word: w.n for w in count_words(frame(docs)).collect()}
    assert rows == {"longword": PIECE // 4, "y" * (PIECE + 9): 3}


def test_given_documents_equal_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    out = QUERIES["op13_spelling_variants"](spark, folder)
    assert dict(out.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    assert got(out) == plain_variants(plain_counts(docs, 97))


def test_clashing_names_and_empty_table(spark, frame):
    docs = frame([(1, "hello hello hello hallo")]).withColumns({n: F.lit("x") for n in ("doc", "word", "n", "key", "near", "length", "form")})
    assert got(variants(count_words(docs))) == {("hello", None, "hello", 3, 0, None)}
    assert variants(count_words(frame([]))).count() == 0
