from __future__ import annotations

import random

from telemill.llm.ngram_join import choose_bands, ngram_join


def brute(rows, threshold=0.8):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().split()
        n = min(5, len(words))
        sets[i] = frozenset(tuple(words[k : k + n]) for k in range(len(words) - n + 1)) if n else frozenset()
    ids, links, root = sorted(sets), {i: 0 for i in sets}, {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(a), find(b)))
                root[y] = x
    copy = {i: min(j for j in ids if sets[j] == sets[i]) if sets[i] else i for i in ids}
    return {i: (find(i), copy[i], links[i]) for i in ids}


def corpus(seed=3):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefg") for _ in range(5)) for _ in range(400)]
    rows, texts = [], [[r.choice(vocabulary) for _ in range(r.randint(30, 120))] for _ in range(25)]
    for words in texts:
        for _ in range(r.choice([1, 1, 2, 6, 40])):
            changed = list(words)
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                changed[r.randrange(len(changed))] = r.choice(vocabulary)
            rows.append((len(rows) * 3, " ".join(changed)))
    return rows + [(9001, None), (9002, ""), (9003, " \n "), (9004, "one two"), (9005, "one  two"), (9006, "one"), (9007, "long " * 6000)]


def test_bands_reach_the_recall():
    bands, rows = choose_bands(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999 > 1 - (1 - 0.8**rows) ** (bands - 1)


def test_equals_brute_force(spark, frame):
    rows = corpus()
    got = {r.doc_id: (r.class_id, r.copy_of, r.n_links) for r in ngram_join(frame(rows)).collect()}
    assert got == brute(rows)


def test_blocks_of_a_large_group(spark, frame):
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*base, f"x{i}"])) for i in range(700)]
    got = ngram_join(frame(rows)).collect()
    assert {r.n_links for r in got} == {699} and {r.class_id for r in got} == {0}


def test_empty_table_null_ids_and_repeated_rows(spark, frame):
    assert ngram_join(frame([])).count() == 0
    got = ngram_join(frame([(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f")])).collect()
    assert sorted((r.doc_id or -1, r.class_id, r.n_links) for r in got) == [(-1, None, 0), (4, 4, 0), (4, 4, 0)]


def test_texts_that_share_an_id_keep_their_links(spark, frame):
    words = lambda c, last: " ".join([*(f"{c}{i}" for i in range(60)), last])
    rows = [(i, words(c, c)) for c in "abcdef" for i in (1,)] + [(10 + i, words(c, "x")) for i, c in enumerate("abcdef")]
    got = ngram_join(frame(rows)).collect()
    assert sorted((r.doc_id, r.class_id, r.copy_of, r.n_links) for r in got) == [(1, 1, 1, 1)] * 6 + [(10 + i, 1, 10 + i, 1) for i in range(6)]


def test_stage_keeps_each_text_of_an_id(spark, frame):
    from corpus_pipeline import near_duplicates

    words = lambda c, last: " ".join([*(f"{c}{i}" for i in range(60)), last])
    rows = [(0, words("a", "x")), (5, words("a", "y")), (5, words("b", "y")), (5, words("b", "y") + " "), (5, words("c", "y"))]
    got = near_duplicates(spark, frame(rows), "").collect()
    assert sorted((r.doc_id, r.text.strip()) for r in got) == [(0, words("a", "x")), (5, words("b", "y")), (5, words("c", "y"))]
