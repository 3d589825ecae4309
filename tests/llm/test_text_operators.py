"""Operators on texts against brute force and against their libraries, with the odd cases of each."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from telemill.llm import decontaminate, line_dedup, quality, secret_scan, substring_dedup, token_counts, token_files, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts(seed, rows=120, low=0, high=90, vocabulary=60):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 6))) for _ in range(vocabulary)]
    passages = [[r.choice(words) for _ in range(r.randint(10, 30))] for _ in range(6)]
    out = []
    for _ in range(rows):
        body = [r.choice(words) for _ in range(r.randint(low, high))]
        for _ in range(r.choice([0, 0, 1, 2])):
            at = r.randint(0, len(body))
            body[at:at] = r.choice(passages)
        out.append("".join(w + r.choice([" ", " ", " ", "\n", "  ", "\t", "\x0b", "\u00a0 "]) for w in body))
    return out + [None, "", " \n ", "one", out[0], "long " * 4000 + "end"]


def test_substrings_equal_brute_force(spark, frame):
    rows = list(enumerate(texts(5)))
    words = {i: WORD.findall(t or "") for i, t in rows}
    first: dict[tuple, int] = {}
    for i in words:
        for k in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][k : k + 13]), i)
    got = {r.doc_id: r for r in substring_dedup.dedup_substrings(frame(rows)).collect()}
    assert got.keys() == words.keys()
    assert sum(r.n_removed for r in got.values()) > 100
    for i, w in words.items():
        gone = {p for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for p in range(k, k + 13)}
        assert got[i].n_words == len(w) and got[i].n_removed == len(gone)
        assert got[i].kept_text == " ".join(x for p, x in enumerate(w) if p not in gone)
        assert {p for s in got[i].repeats for p in range(s.start, s.end)} == gone


def test_substrings_of_null_ids_and_repeated_rows(spark, frame):
    text = " ".join(f"w{i}" for i in range(20))
    got = substring_dedup.dedup_substrings(frame([(None, text), (3, text), (3, text), (5, text)])).collect()
    assert sorted((r.doc_id or -1, r.n_removed) for r in got) == [(-1, 0), (3, 0), (3, 0), (5, 20)]
    assert substring_dedup.dedup_substrings(frame([])).count() == 0


def test_line_windows_equal_brute_force(spark, frame):
    r = random.Random(2)
    pool = [f"line {i} " for i in range(12)] + ["", "  ", "\t"]
    rows = [(i * 2, "\n".join(r.choice(pool) for _ in range(r.randint(0, 9)))) for i in range(150)]
    rows += [(1001, None), (1002, "one\ntwo"), (1003, "a\nb\nc"), (1004, " a\n\nb \nc\nd"), (1005, "same\n" * 2000)]
    seen, want = set(), {}
    for i, text in sorted(rows):
        lines = (text or "").split("\n")
        shown = [n for n, x in enumerate(lines) if x.strip(" \t\x0b\x0c\r")]
        gone = set()
        for k in range(len(shown) - 2):
            key = tuple(lines[n].strip(" \t\x0b\x0c\r") for n in shown[k : k + 3])
            if key in seen:
                gone.update(shown[k : k + 3])
            seen.add(key)
        want[i] = (None if text is None else "\n".join(x for n, x in enumerate(lines) if n not in gone), len(gone))
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_lines(frame(rows)).collect()}
    assert got == want
    assert want[1004][0] == " a\n\nb \nc\nd".replace(" a\n", "", 1).replace("b \n", "").replace("c\n", "") and sum(n for _, n in want.values()) > 100


def test_line_windows_of_null_ids_repeats_and_extra_columns(spark, frame):
    same = "a\nb\nc"
    docs = frame([(None, same), (1, same), (1, same), (2, same)]).withColumn("starts", F.lit(1)).withColumn("at", F.lit("x"))
    got = line_dedup.dedup_lines(docs)
    assert got.columns == [*docs.columns, "n_removed"]
    assert sorted((r.doc_id or -1, r.text) for r in got.collect()) == [(-1, same), (1, same), (1, same), (2, "")]
    assert line_dedup.dedup_lines(frame([])).count() == 0


def brute_quality(text):
    words = WORD.findall(text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {i for i, g in enumerate(grams) if grams.count(g) > 1}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
        len({p for i in again for p in (i, i + 1, i + 2)}),
    )


def test_quality_counts_equal_brute_force(spark, frame):
    rows = [(i, t) for i, t in enumerate(texts(8, rows=60, vocabulary=12)) if len(t or "") < 5000]
    rows += [(900, "a b a b a b a"), (901, "# x\n# x\n y <|>\r\n\n \n"), (902, "x " * 3)]
    for r in quality.judged(frame(rows)).collect():
        q, text = r.quality, dict(rows)[r.doc_id]
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == brute_quality(text), text
        assert q.base_failed == (q.n_words < 50 or 100 * q.n_repeat_words > 50 * q.n_words)
        assert not (q.kept and q.base_failed)


def test_quality_rejects_by_lines_and_keeps_clean_prose(spark, frame):
    r = random.Random(4)
    prose = "\n".join("The " + " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(12)) + "." for _ in range(8))
    shouted = prose.upper().replace(" ", "!! ")
    menu = "Home | About | Contact\nAll rights reserved.\n"
    rows = [(1, prose), (2, shouted), (3, menu + prose), (4, None), (5, ""), (1, prose), (None, prose)]
    docs = frame(rows).withColumn("quality_", F.lit(0))
    got = quality.clean_documents(docs)
    assert got.columns == docs.columns
    out = sorted((x.doc_id or -1, x.text, x.n_chars) for x in got.collect())
    assert out == [(-1, prose, len(prose)), (1, prose, len(prose)), (1, prose, len(prose)), (3, prose, len(prose))]
    assert quality.clean_documents(frame([])).count() == 0


def test_quality_shouts_by_share_and_dated_footers(spark, frame):
    shouts = lambda x: sum(map(str.isalpha, x)) >= 20 and 10 * sum(map(str.isupper, x)) > 7 * sum(map(str.isalpha, x))
    lines = [
        "BUY NOW AND VISIT OUR iSTORE TODAY", "A LONG LINE OF CAPITAL LETTERS WITH ONE x", "SHORT Line", "ABCDEFGHIJKLMNO abcdef",
        "ABCDEFGHIJKLMNOP abcdef", "ABCDEFGHIJKLMN abcdef", "ABCDEFGHIJKLMNO abcde", "A B C D E F G H I J K L M N O p q r s t", "A-B-C-D E F G H I J K L M N p q r s t",
        "ABCDEFGHIJKLMNOPQRST" + "日" * 30, "ABCDEFGHIJKLMNO" + "日" * 5, "Most of this line is small but NASA, ESA, JAXA, CNSA and ISRO are not.",
    ]
    footers = ["Copyright 2024 Example Inc.", "COPYRIGHT 1999 x", "© 2024 Example", "see ©2024 there"]
    others = ["The copyright of 2024 is new.", "Copyright law since 1999.", "A © sign."]
    rows = list(enumerate(lines + footers + others))
    got = {r.doc_id: r.quality.clean_text == "" for r in quality.judged(frame(rows)).collect()}
    assert got == {i: shouts(x) or x in footers for i, x in rows}
    assert sum(got.values()) == 11


def brute_spans(text):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(found))


def test_secrets_equal_brute_force_and_ownership_decides(spark):
    r = random.Random(6)
    bits = ["password=", "Token: '", "api_key = ", "ſecret=", "AKIA", "KIA", "deadbeef" * 4, "é", " ", "x9Y", "=", "token=", "\n"]
    rows = [(i, "".join(r.choice(bits) for _ in range(r.randint(0, 20))), f"o{i % 5}", "en") for i in range(300)]
    common, own = "Zq8xT1vB6nM3kL0pR5wY", "aB3dE5gH7jK9mN1pQ3sT5"
    rows += [(1000 + i, f"see {common} here", f"o{i}", "en") for i in range(4)] + [(2000, f"see {own} here", "o1", "en"), (2001, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    got = secret_scan.scan_secrets(docs, F.col("lang"), F.col("source")).collect()
    assert len(got) == len(rows)
    by_id = {x.doc_id: x for x in got}
    for i, text, _, _ in rows:
        want = brute_spans(text or "")
        assert by_id[i].base_spans == want and set(filter(None, want.split(","))) <= set(by_id[i].spans.split(","))
        counts = by_id[i].n_assign, by_id[i].n_access, by_id[i].n_hex
        assert counts == tuple(want.count(k + ":") for k in ("assign", "access", "hex"))
    assert by_id[1001].spans == "" and by_id[1001].n_example == 1
    assert by_id[2000].spans == "opaque:4:25" and by_id[2000].n_live == 1
    assert secret_scan.scan_secrets(docs.limit(0), F.col("lang"), F.col("source")).count() == 0


RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/")]


def test_url_rules_and_odd_addresses(spark):
    urls = [
        ("https://a.COM/x?y#z", "a.com", "/x", "com/", "allow"), ("http://example.com/en/1", "example.com", "/en/1", "example.com/en/", "block"),
        ("http://www.example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("ftp://x.net/es/", "x.net", "/es/", "net/es/", "block"), ("http://notcom/", "notcom", "/", None, None),
        ("http://a.com", "a.com", "", None, None), (None, "", "", None, "block"), ("no scheme", "", "", None, "block"),
        ("a://É.com/p://q", "É.com", "/p://q", "com/", "allow"),
    ]
    rows = [(i, u[0], "kept") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, score string").drop("score")
    got = {r.page_id: r for r in url_filter.filter_urls(pages, RULES).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(urls):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == verdict if verdict else got[i].verdict in ("allow", "block")
    assert url_filter.filter_urls(pages.limit(0), RULES).count() == 0


def test_url_model_separates_held_out_addresses(spark):
    r = random.Random(9)
    name = lambda letters: "".join(r.choice(letters) for _ in range(10))
    rows = [(i, f"http://{name('abcde')}.com/{name('abcde')}") for i in range(600)] + [(i + 600, f"http://{name('vwxyz')}.net/es/{name('vwxyz')}") for i in range(600)]
    rows += [(2000 + i, f"http://{name('abcde')}.org/{name('abcde')}") for i in range(200)] + [(3000 + i, f"http://{name('vwxyz')}.org/{name('vwxyz')}") for i in range(200)]
    got = url_filter.filter_urls(spark.createDataFrame(rows, "page_id bigint, url string"), RULES).filter("rule IS NULL").collect()
    right = sum((x.verdict == "allow") == (x.page_id < 3000) for x in got)
    assert len(got) == 400 and right >= 380


def brute_scores(counted, asked, order=5, prior=4.0):
    """Scores by models of all n-grams of (label, shape) rows."""
    seen, after = {}, {}
    for label, shape in counted:
        padded = "\x02" * order + shape + "\x03"
        for i in range(order, len(padded)):
            for k in range(order + 1):
                seen[label, padded[i - k : i + 1]] = seen.get((label, padded[i - k : i + 1]), 0) + 1
                after[label, padded[i - k : i]] = after.get((label, padded[i - k : i]), 0) + 1

    def mean(label, shape):
        padded, total = "\x02" * order + shape + "\x03", 0.0
        for i in range(order, len(padded)):
            p = 1 / 96
            for k in range(order + 1):
                if n := after.get((label, padded[i - k : i])):
                    p = (seen.get((label, padded[i - k : i + 1]), 0) + prior * p) / (n + prior)
            total += math.log(p)
        return total / (len(shape) + 1)

    return {shape: mean("allow", shape) - mean("block", shape) for shape in asked}


def test_url_models_hold_every_ngram(spark):
    r = random.Random(12)
    name = lambda letters, n: "".join(r.choice(letters) for _ in range(n))
    hosts = [("allow", f"{name('abcde', 8)}.com", f"/{name('abcdefgh', 20)}") for _ in range(700)]
    hosts += [("block", f"{name('efgh', 8)}.net", f"/es/{name('abcdefgh', 20)}") for _ in range(700)]
    rest = [(None, f"{name('abcdefgh', 8)}.org", f"/{name('abcdefgh', 20)}") for _ in range(150)]
    rows = [(i, f"http://{host}{path}", host, path) for i, (_, host, path) in enumerate(hosts + rest)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, h string, p string")
    trained = pages.select("page_id", (url_filter.fold_of(F.concat("h", "p")) > 0).alias("counted")).collect()
    known = [(hosts[x.page_id][0], "".join(hosts[x.page_id][1:])) for x in trained if x.counted and x.page_id < len(hosts)]
    held = [(hosts[x.page_id][0], "".join(hosts[x.page_id][1:])) for x in trained if not x.counted and x.page_id < len(hosts)]
    assert held and not {shape for _, shape in held} & {shape for _, shape in known}
    assert sum(len(shape) + 1 for label, shape in known if label == "allow") > 3 * 5_000
    want = brute_scores(known, ["".join(x[1:]) for x in rest])
    judged = url_filter.filter_urls(pages.withColumns({"_shape_": F.lit("x"), "_ruled_": F.lit("y")}), RULES).filter("rule IS NULL").collect()
    assert {(x._shape_, x._ruled_) for x in judged} == {("x", "y")}
    got = {x.host + x.path: x.score for x in judged}
    assert got.keys() == want.keys()
    assert max(abs(got[shape] - want[shape]) for shape in want) < 1e-6
    # the threshold: of all steps the one with the least mean of both error rates on the held-out shapes, nearest to zero
    scores = brute_scores(known, [shape for _, shape in held])
    n = Counter(label for label, _ in held)
    wrong = lambda t: sum((label == "allow") != (scores[shape] >= t) and 1 / n[label] for label, shape in held)
    steps = [(k - 0.5) * url_filter.STEP for k in range(-200, 201)]
    least = min(map(wrong, steps))
    best = min((t for t in steps if wrong(t) <= least + 1e-9), key=abs)
    near = [x for x in judged if abs(x.score - best) > url_filter.STEP]
    assert len(near) > 100 and all(x.verdict == ("allow" if x.score >= best else "block") for x in near)


def test_token_files_round_trip(spark, frame, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    r = random.Random(3)
    odd = ["It's 3.14, ISN'T it?", "ÀÉ ß ÿ Σας", "e\u0301 \u0301x", "a<|endoftext|>b <|startoftext|>", "\u2003x\u00a0y", "日本 語😀", "İstanbul K", "a_b c--d ...", "x" * 3000]
    rows = list(enumerate(texts(7, rows=40) + odd + ["".join(r.choice("aÉ \u0301,'s9\n") for _ in range(12)) for _ in range(300)]))
    r.shuffle(rows)
    target = str(tmp_path / "tokens")
    token_files.write_tokens(frame(rows), target, path, 1)
    got = token_files.read_tokens(spark, target)
    crc = {x.doc_id: x.ids_crc32 for x in token_files.with_checksum(got).collect()}
    start = 0
    for x in sorted(got.collect()):
        ids = library.encode(dict(rows)[x.doc_id] or "", add_special_tokens=False).ids + [1]
        assert list(x.ids) == ids and x.n_tokens == len(ids) and x.start == start
        assert crc[x.doc_id] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert token_files.token_index(spark, target).count() == len(rows)
    plan = token_files.token_index(spark, target)._jdf.queryExecution().executedPlan().toString()
    assert "ids:array" not in plan


def test_token_files_of_nulls_repeats_and_no_rows(spark, frame, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    token_files.write_tokens(frame([(2, "b"), (None, None), (2, "b")]), str(tmp_path / "a"), path, 1)
    got = sorted((x.start, x.doc_id, len(x.ids)) for x in token_files.read_tokens(spark, str(tmp_path / "a")).collect())
    assert got == [(0, None, 1), (1, 2, 2), (3, 2, 2)]
    token_files.write_tokens(frame([]), str(tmp_path / "b"), path, 1)
    assert token_files.read_tokens(spark, str(tmp_path / "b")).count() == 0


def test_token_counts_equal_the_library(spark, frame):
    from tokenizers import Tokenizer, models, pre_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    vocabulary = token_counts.vocabulary_of(model)
    library = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    r = random.Random(2)
    odd = ["", " ", "  a", "▁x ▁", "日本 語😀😀 x", "<s> <0x41>", "a\nb", "é́ｆ"]
    rows = list(enumerate(texts(4) + odd + ["".join(r.choice("abe  ▁\nthé1,日😀") for _ in range(r.randint(0, 25))) for _ in range(500)]))
    got = {x.doc_id: x.n_tokens for x in token_counts.count_tokens(frame(rows), model).collect()}
    for i, text in rows:
        assert got[i] == len(library.encode(text or "", add_special_tokens=False).ids), text
    assert token_counts.count_tokens(frame([]), model).count() == 0


def test_token_counts_break_ties_and_join_unknown_characters():
    from tokenizers import Tokenizer, models, pre_tokenizers

    r = random.Random(5)
    pieces = {"▁": -1.0, "<unk>": 0.0} | {"".join(r.choice("▁abc") for _ in range(r.randint(1, 4))): float(-r.randint(1, 4)) for _ in range(40)}
    vocabulary = sorted(pieces.items())
    library = Tokenizer(models.Unigram(vocabulary, unk_id=[p for p, _ in vocabulary].index("<unk>")))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    counter = token_counts.UnigramCounter(vocabulary)
    cases = ["".join(r.choice("abcxy ") for _ in range(r.randint(0, 14))) for _ in range(3000)]
    for text, count in zip(cases, counter.count_batch(cases)):
        assert count == len(library.encode(text, add_special_tokens=False).ids), text


def sellers(item, text):
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, x in enumerate(item):
            new.append(min(row[i] + (x != c), row[i + 1] + 1, new[-1] + 1))
        row = new
        best = min(best, row[-1])
    return best


def test_edit_matches_equal_brute_force(spark, frame):
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcd") for _ in range(r.randint(2, 6)))
    items = [(i, " ".join(word() for _ in range(r.randint(3, 25)))) for i in range(25)] + [(25, None), (26, " "), (27, "ab")]
    rows = []
    for i in range(150):
        body = list(" ".join(word() for _ in range(20)))
        part = list(r.choice(items[:25])[1].upper())
        for _ in range(r.choice([0, 0, 1, 3, 6])):
            at = r.randrange(len(part))
            part[at : at + 1] = r.choice([[], ["x"], ["y", part[at]]])
        at = r.randint(0, len(body))
        rows.append((i, "".join(body[:at] + part + [" \n "] + body[at:])))
    rows += [(900, None), (901, ""), (902, items[3][1]), (902, items[3][1])]
    want = set()
    for i, text in rows:
        for k, item in items:
            plain = decontaminate.plain(item)
            if plain and (d := sellers(plain, decontaminate.plain(text))) <= len(plain) // decontaminate.CHARS_AN_EDIT:
                want.add((i, k, d))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = [tuple(x) for x in decontaminate.find_items(frame(rows), bench).collect()]
    assert set(got) == want and sum(x[0] == 902 for x in got) % 2 == 0
    hit = {i for i, _, _ in want}
    docs = frame(rows)
    kept = decontaminate.clean_documents(docs, bench)
    assert kept.columns == docs.columns and sorted(x.doc_id for x in kept.collect()) == sorted(i for i, _ in rows if i not in hit)
    assert decontaminate.find_items(docs, bench.limit(0)).count() == 0 and decontaminate.find_items(docs.limit(0), bench).count() == 0
