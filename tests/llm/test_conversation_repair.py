from __future__ import annotations

import hashlib
import random
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from telemill.llm import conversation_repair
from telemill.llm.conversation_repair import Repair, damage
from telemill.llm.edit_paths import Paths, Turn, solve
from telemill.llm.queries import QUERIES

KIND = "conv_id bigint, turn bigint, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate(str.maketrans("", "", ".!?"))
        out += [] if kind == 0 else [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(turns):
    """From the end: the cheapest (cost, edits) of what is left, of equal cost the least text."""

    @lru_cache(None)
    def rest(i, state, inserts):
        ways = [(0, "")] if i == len(turns) and state in "0a" else []
        following = {"0": "u", "s": "u", "u": "a", "a": "u"}[state]
        if inserts < 2:
            cost, edits = rest(i, following, inserts + 1)
            ways.append((cost + 5, "I" + edits))
        if i < len(turns):
            initial, fault = turns[i]
            late = 5 if fault == "truncated" else 0
            cost, edits = rest(i + 1, state, 0)
            ways.append((cost + 2, "D" + edits))
            if fault not in ("blank", "duplicate"):
                if initial == following or (initial == "s" and state == "0"):
                    cost, edits = rest(i + 1, initial, 0)
                    ways.append((cost + late, "K" + edits))
                cost, edits = rest(i + 1, following, 0)
                ways.append((cost + 1 + late, "R" + edits))
        return min(ways, default=(10**9, ""))

    for i in range(len(turns), 0, -1):  # so that no call goes deep
        for state in "0sua":
            rest(i, state, 0)
    return rest(0, "0", 0)


def plain_repair(conv, rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, faults = set(), []
    for _, _, role, text in rows:
        shown = text.strip(WHITE)
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else None if shown[-1] in ".!?" else "truncated"
        faults.append(fault)
        seen.add((role, text))
    known = [r[1] for r in rows if r[1] is not None]
    cost, edits = cheapest(tuple((r[2][:1], f) for r, f in zip(rows, faults)))
    left, state, given = [], "0", iter(rows)
    for e in edits:
        row = next(given) if e != "I" else None
        if e == "D":
            continue
        state = row[2][:1] if e == "K" else "a" if state == "u" else "u"
        role = row[2] if e == "K" else {"u": "user", "a": "assistant"}[state]
        left.append(f"{role}:{row[3] if row else ''}")
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    return (
        conv, max(known) - min(known) + 1 - len(set(known)) if known else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
        sum(p not in ("su", "ua", "au") for p in pairs), cost, edits, hashlib.sha256("\n".join(left).encode()).hexdigest(),
    )


def expected(given):
    rows = plain_damage(given)
    return sorted((plain_repair(c, [r for r in rows if r[0] == c]) for c in {r[0] for r in given}), key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def drawn(r, conv):
    roles, texts = ["user", "assistant", "system", "tool", "", None, "user", "assistant"], ["a.", "b!", "b", "", " \t", None, "c?\n", "a. ", "é.\x85"]
    turns = [r.choice([None, r.randint(0, 4), k, k, k]) for k in range(r.randint(1, 9))]
    return [(conv, t, r.choice(roles), r.choice(texts)) for t in turns]


@pytest.mark.parametrize("rows, chars", [(4_096, 4 << 20), (3, 1 << 20), (1, 1)])
def test_random_conversations_equal_brute_force(spark, monkeypatch, rows, chars):
    monkeypatch.setattr(conversation_repair, "FRAGMENT_ROWS", rows)
    monkeypatch.setattr(conversation_repair, "FRAGMENT_CHARS", chars)
    r = random.Random(rows)
    given = [row for conv in [None, *range(300)] for row in drawn(r, conv)]
    assert got(Repair(damage(spark.createDataFrame(given, KIND))).verdicts()) == expected(given)


def test_one_conversation_over_many_tasks(spark):
    r = random.Random(8)
    given = [(7, k, r.choice(["user", "assistant"]), f"{r.choice('abc')}{r.randint(0, 900)}{r.choice('.!x')}") for k in range(3000)]
    given += [(8, 1, "user", "same.")] * 500 + [(8, 2, "assistant", "end.")]
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # as many tasks as a large table has
    try:
        repair = Repair(damage(spark.createDataFrame(given, KIND).repartition(7)))
    finally:
        spark.conf.unset(key)
    assert repair.fragments.filter("conv_id = 7").count() > 1
    rows = {row.conv_id: row for row in repair.verdicts().collect()}
    assert sorted((tuple(row) for row in rows.values()), key=repr) == expected(given)
    lines = repair.turns().filter("conv_id = 7").orderBy("piece", "line").collect()
    assert hashlib.sha256("\n".join(f"{x.role}:{x.text}" for x in lines).encode()).hexdigest() == rows[7].repaired_sha256
    assert [x.role[0] for x in lines] == ["u", "a"] * (len(lines) // 2)


def test_given_conversations_equal_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    given = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    out = QUERIES["op12_conversation_repair"](spark, folder)
    assert out.columns == "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    assert got(out) == expected(given)


def test_damage(spark):
    given = [(c, t, role, text) for c in [None, *range(60)] for t, role, text in [(0, "user", "a.b!?"), (None, None, None)]]
    frame = damage(spark.createDataFrame(given, KIND))
    rows = [r for r in frame.collect() for _ in range(r.times)]
    assert sorted(((r.conv_id, r.turn, r.role, r.text) for r in rows), key=repr) == sorted(plain_damage(given), key=repr)


def test_extreme_turns_clashing_names_and_empty_table(spark):
    far = [(1, -(1 << 63), "user", "a."), (1, (1 << 63) - 1, "assistant", "b."), (2, 1, "user", "x" * 3_000_000 + "."), (2, 2, "assistant", "y.")]
    names = ("times", "a", "b", "again_id", "first", "piece", "initial", "cut", "edits")
    frame = spark.createDataFrame(far, KIND).withColumns({n: F.lit(1) for n in names})
    assert [(r.conv_id, r.gaps, r.cost, r.audit) for r in Repair(frame).verdicts().orderBy("conv_id").collect()] == [
        (1, (1 << 63) - 1, 0, "KK"), (2, 0, 0, "KK"),
    ]
    assert Repair(damage(spark.createDataFrame([], KIND))).verdicts().count() == 0


def test_nodes_compare_like_their_letters():
    r, paths = random.Random(1), Paths()
    nodes = [0]
    for _ in range(600):
        nodes.append(paths.add(r.choice(nodes[-40:]), r.choice("DIKR")))
    for _ in range(4000):
        a, b = r.choice(nodes), r.choice(nodes)
        assert paths.less(a, b) == (paths.spelled(a) < paths.spelled(b))


def test_equal_hashes_do_not_decide(monkeypatch):
    monkeypatch.setattr(Paths, "digest", staticmethod(lambda before, letter: 0))
    r = random.Random(4)
    for _ in range(200):
        turns = [(r.choice("suat"), r.choice(["blank", "truncated", None, None])) for _ in range(r.randint(0, 7))]
        found = [s for s in solve([Turn(i, f == "blank", f == "truncated") for i, f in turns], 0) if s.end in (0, 3)]
        best = min(found, key=lambda s: (s.cost, s.edits))
        assert (best.cost, best.edits) == cheapest(tuple(turns))
