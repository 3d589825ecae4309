"""Dumps as a data source, nested lists, unbounded keys, balanced ranges and digests of ranges."""

from __future__ import annotations

import json
import lzma
import random
import subprocess
import sys
import textwrap
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from telemill.functions.jdl import OTHER, decode_jdl, entry_of, flatten_served
from telemill.operators import digests
from telemill.operators.quality import reconcile
from telemill.plans import jobs
from telemill.plans.lake import Lake
from telemill.session import scratch, ship
from telemill.sources import dump_feed, dumps, nested, ranges
from telemill.streaming import ingest


def put(folder, epoch, lines, tail=b""):
    folder.mkdir(exist_ok=True)
    (folder / f"site-sonar-{epoch}.out.xz").write_bytes(lzma.compress("\n".join(lines).encode()) + tail)


def lines_in(frame):
    return sorted((r.epoch, r.line) for r in frame.collect())


def test_dump_source_equals_the_reader(spark, tmp_path):
    ship(spark)
    for epoch in (100, 200, 300):
        put(tmp_path / "feed", epoch, [f'{{"a": {epoch + i}}}' for i in range(50)] + ["", "odd"])
    (tmp_path / "feed" / "notes.txt").write_text("x")
    rows = dump_feed.dump_rows(spark, str(tmp_path / "feed"))
    content = spark.read.format("binaryFile").option("pathGlobFilter", "*.xz").load(str(tmp_path / "feed")).select("path", "content")
    want = sorted((r.line_no, r.line) for r in dumps.dump_lines(content).collect())
    assert sorted((r.line_no, r.line) for r in rows.collect()) == want and len(want) == 153
    some = dump_feed.dump_rows(spark, f"file://{tmp_path}/feed", after=100, upto=200)
    assert {r.epoch for r in some.collect()} == {200}
    assert dump_feed.dump_rows(spark, str(tmp_path / "nowhere")).count() == 0


def test_dump_stream_reads_each_file_once(spark, tmp_path):
    ship(spark)

    def run():
        stream = dump_feed.dump_stream(spark, str(tmp_path / "feed"))
        ingest.write_available(stream, str(tmp_path / "out"), str(tmp_path / "state"))
        return lines_in(spark.read.parquet(str(tmp_path / "out")))

    put(tmp_path / "feed", 1, ["a"])
    put(tmp_path / "feed", 2, ["b", "c"])
    assert run() == [(1, "a"), (2, "b"), (2, "c")]
    put(tmp_path / "feed", 3, ["d"])
    assert run() == run() == [(1, "a"), (2, "b"), (2, "c"), (3, "d")]
    assert lines_in(dump_feed.dump_rows(spark, str(tmp_path / "feed"), after=2)) == [(3, "d")]


def test_streams_of_xz_are_read_step_by_step():
    parts = [b"one\ntwo", b"\nthree\n", "ü\n".encode() * 1000]
    whole = b"".join(lzma.compress(p) + b"\0" * pad for p, pad in zip(parts, (0, 8, 4)))

    class Slow:
        def __init__(self, data, size):
            self.data, self.size, self.at = data, size, 0

        def read(self, _):
            out = self.data[self.at : self.at + self.size]
            self.at += self.size
            return out

    for size in (1, 7, 1 << 20):
        for tail in (b"", b"no stream, but long enough"):
            assert b"".join(dumps._decoded(Slow(whole + tail, size), "x")) == b"".join(parts)
        with pytest.raises(lzma.LZMAError):
            list(dumps._decoded(Slow(whole[:-30], size), "x"))
        for broken in (b"", b"not a dump at all, is it"):
            with pytest.raises(lzma.LZMAError):
                list(dumps._decoded(Slow(broken, size), "x"))


def test_memory_of_a_large_dump(tmp_path):
    """A dump of 200 MB is read with a small part of that in memory."""
    with lzma.open(tmp_path / "site-sonar-9.out.xz", "wb", preset=0) as out:
        for _ in range(20):
            out.write(b"x" * 99 + b"\n" + (b"y" * 99 + b"\n") * 99_999)
    code = f"""
        import resource
        from telemill.sources.dump_feed import Share, read_share
        rows = sum(b.num_rows for b in read_share(Share("{tmp_path}", 0, 1, -1, 99)))
        print(rows, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
    """
    out = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], capture_output=True, text=True, check=True, cwd=Path(dumps.__file__).parents[2])
    rows, peak = map(int, out.stdout.split())
    assert rows == 2_000_000 and peak < 400


def test_dump_job_counts_late_rows(spark, tmp_path):
    store = Lake(spark, scratch(spark, "late"))
    row = lambda at: json.dumps({"host_id": at, "hostname": "h", "last_updated": at})
    put(tmp_path, 1, [row(100), row(50)])
    assert jobs.run_dumps(store, dumps.dump_files(spark, str(tmp_path)), "a").first().late == 0
    put(tmp_path, 2, [row(99), row(100), row(7), row(101)])
    assert jobs.run_dumps(store, dumps.dump_files(spark, str(tmp_path)), "b").first().late == 2
    put(tmp_path, 3, [row(1)])
    last = jobs.run_dumps(store, dumps.dump_files(spark, str(tmp_path)), "c").first()
    assert (last.late, last["read"], last.mark_after) == (1, 1, 3) and store.read("site_sonar").count() == 4


# ---- nested lists -------------------------------------------------------------------------------------


def plain_children(doc, parent, table, out):
    """Lists of one document, by recursion: (table, parent, place, scalar or None)."""

    def walk(value, name, holder):
        if isinstance(value, dict):
            for key, inner in value.items():
                walk(inner, f"{name}__{key}", holder)
        elif isinstance(value, list):
            child = name if name != holder[1] else f"{name}__list"
            for place, item in enumerate(value):
                me = (*holder[0], child, place)
                out.append((child, holder[0], place, None if isinstance(item, (dict, list)) else item))
                walk(item, child, (me, child))

    walk(doc, table, ((parent,), table))


DOCS = [
    {"os": {"n": 1}, "gpus": [{"name": "a", "fans": [1, 2], "t": {"x": True}}, {"name": None, "fans": []}], "m": [[1, 2], [3]]},
    {"gpus": "none", "m": [5, ["q"], {"z": [[["deep"]]]}], "odd key": [{"it's": [None, 1], 'a"b\'c': ["both"]}]},
    {"a": [], "b": {"c": {"d": ["x", {"e": "f"}]}}},
    None, 3, [1, [2]], {"m": {"y": ["here"]}, "os": 4}, {"os": {"n": {"l": [1.5]}}},
]


def test_lists_at_any_depth(spark):
    rows = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(DOCS)] + [(99, None)], "id int, text string")
    tables = nested.child_tables(rows.select("id", F.try_parse_json("text").alias("v")), F.col("id"), "v", "t")
    want: list = []
    for i, doc in enumerate(DOCS):
        plain_children(doc, str(i), "t", want)
    ids = {str(i): (str(i),) for i in range(len(DOCS))}
    seen = []
    for name in sorted(tables, key=lambda n: n.count("__")):
        found = tables[name].collect()
        assert len({r["_id"] for r in found}) == len(found)
        for r in found:
            ids[r["_id"]] = (*ids[r["_parent_id"]], name, r["_list_idx"])
            seen.append((name, ids[r["_parent_id"]], r["_list_idx"]))
    assert sorted(seen) == sorted((t, p, k) for t, p, k, _ in want)
    values = {(n, ids[r["_parent_id"]], r["_list_idx"]): r["value"] for n, t in tables.items() if "value" in t.columns for r in t.collect()}
    for table, parent, place, item in want:
        if item is not None:
            assert values[table, parent, place] == (str(item) if not isinstance(item, bool) else str(item).lower())
    gpus = {r["_list_idx"]: (r["name"], r["t__x"]) for r in tables["t__gpus"].collect()}
    assert gpus == {0: ("a", "true"), 1: (None, None)}


def test_no_lists_and_no_rows(spark):
    rows = spark.createDataFrame([(1, '{"a": {"b": 2}}')], "id int, text string").select("id", F.parse_json("text").alias("v"))
    assert nested.child_tables(rows, F.col("id"), "v", "t") == {}
    assert nested.child_tables(rows.filter("id > 1"), F.col("id"), "v", "t") == {}


# ---- unbounded keys --------------------------------------------------------------------------------------


def test_as_many_keys_as_rows(spark):
    texts = spark.range(0, 20_000, 1, 8).select("id", F.expr("""concat('{"TTL":"', id % 9, '","Own', id, '":', id, ',"cpu_cores":null,"Cpu_Cores":"4"}')""").alias("full_jdl"))
    flat = flatten_served(decode_jdl(texts, exact_tokens=False), ["TTL", "CPUCores"])
    assert flat.columns == ["id", "jdl_parse_ok", "full_jdl_raw", "jdl__ttl", "jdl__cpu_cores", OTHER]
    # the names of the columns are known before a row is read
    wrong = (F.size(OTHER) != 1) | (F.col("jdl__cpu_cores") != "4") | (F.col("jdl__ttl") != (F.col("id") % 9).cast("string"))
    assert flat.filter(wrong | (F.element_at(OTHER, F.concat(F.lit("Own"), "id")) != F.col("id").cast("string"))).count() == 0


def test_nightly_keeps_unknown_keys_and_counts_them(spark):
    store = Lake(spark, scratch(spark, "keys"))
    rows = lambda ids: spark.createDataFrame([(i, "t", json.dumps({"TTL": "1", f"New{i}": [i]})) for i in ids], "job_id bigint, lpmjobtypeid string, full_jdl string")
    empty = {"job_info": spark.createDataFrame([], "job_id bigint, last_update timestamp_ntz"), "trace": spark.createDataFrame([], "job_id bigint, laststatuschangetimestamp bigint")}
    jobs.run_nightly(store, empty | {"mon_jdls": rows([1, 2])}, "n1", evolve=False)
    jobs.run_nightly(store, empty | {"mon_jdls": rows([3])}, "n2", evolve=False, promoted=["New3", "New1"])
    jobs.run_nightly(store, empty | {"mon_jdls": rows([4])}, "n3", evolve=False)
    table = store.read("mon_jdls_parsed")
    got = {r.job_id: (r.a, r.b, r[OTHER]) for r in table.select("job_id", entry_of("New1", table.columns).alias("a"), entry_of("New3", table.columns).alias("b"), OTHER).collect()}
    assert got == {1: ("[1]", None, {"New1": "[1]"}), 2: (None, None, {"New2": "[2]"}), 3: (None, "[3]", {}), 4: (None, None, {"New4": "[4]"})}
    jobs.run_nightly(store, empty | {"mon_jdls": rows([5])}, "n4")  # from now on new keys are columns
    assert store.read("mon_jdls_parsed").filter("job_id = 5").first()["jdl__new5"] == "[5]" and store.read("mon_jdls_parsed").filter("job_id = 4").first()[OTHER] == {"New4": "[4]"}
    census = {(r.load_id, r.key): r.rows for r in store.read(jobs.KEYS).collect()}
    assert census == {("n1", "TTL"): 2, ("n1", "New1"): 1, ("n1", "New2"): 1, ("n2", "TTL"): 1, ("n2", "New3"): 1, ("n3", "TTL"): 1, ("n3", "New4"): 1}


# ---- balanced ranges -----------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 7, 32])
def test_ranges_hold_equal_shares(spark, n):
    keys = spark.range(50_000).select(F.expr("id * id * id").alias("job_id"), (F.col("id") % 1000).alias("other"))
    found = ranges.balanced_ranges(keys, "job_id", n)
    counts = ranges.range_counts(keys, "job_id", found).collect()
    assert len(counts) == len(found) == n and sum(r.rows for r in counts) == 50_000
    assert max(r.rows for r in counts) <= 1.2 * 50_000 / n


def test_a_hot_key_is_split_by_another_column(spark):
    keys = spark.range(30_000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("job_id"), F.col("id").alias("other"))
    keys = keys.unionByName(spark.range(3).select(F.lit(None).cast("bigint").alias("job_id"), F.col("id").alias("other")))
    found = ranges.balanced_ranges(keys, "job_id", 10, split_hot=True)
    counts = ranges.range_counts(keys, "job_id", found, "other").collect()
    assert sum(r.rows for r in counts) == 30_003 and None not in {r.part for r in counts}
    assert max(r.rows for r in counts) <= 2 * 30_003 / 10
    texts = [r.predicate("job_id", "other", nulls=True) for r in found]
    assert sum(keys.filter(text).count() for text in texts) == 30_003
    assert ranges.balanced_ranges(keys.filter("false"), "job_id", 4) == [ranges.KeyRange(None, None)]


def test_ranges_of_keys_beyond_bigint(spark, tmp_path):
    """Cubes of keys of the sixtyfold table: no overflow, each row in one range, whole numbers in the conditions."""
    from telemill.plans.domain import Given
    from telemill.plans.queries_feed import RANGES, _skewed, extraction_ranges

    spark.range(0, 9_000_000, 900).selectExpr("id AS o_orderkey", "id AS o_custkey").write.parquet(f"{tmp_path}/orders.parquet")
    given = Given(spark, str(tmp_path))
    assert extraction_ranges(given).collect() == [(RANGES, 10_000, True, True)]
    found = ranges.balanced_ranges(_skewed(given), "job_id", 4)
    assert len(found) == 4 and all(isinstance(r.hi, int) for r in found[:-1]) and found[-1].lo > 2**63


# ---- digests of ranges ----------------------------------------------------------------------------------


def test_only_differing_ranges_are_read_again(spark):
    r = random.Random(3)
    left = {r.randrange(-50_000, 50_000): r.choice("abc") for _ in range(5_000)}
    right = dict(left)
    for key in r.sample(sorted(left), 5):
        right.pop(key)
    for key in r.sample(sorted(right), 5):
        right[key] += "!"
    right |= {60_000: "new", -60_000: None}
    frames = [spark.createDataFrame(list(rows.items()), "job_id bigint, status string") for rows in (left, right)]
    verdict, read = digests.reconcile_by_ranges(*frames, "job_id", ["job_id", "status"], 100)
    assert sorted(map(tuple, verdict.collect())) == sorted(map(tuple, reconcile(*frames, "job_id", ["job_id", "status"]).collect()))
    row = read.first()
    assert row.rows == len(left) + len(right) and row.ranges <= 12 and 0 < row.read_again < 12 * 2 * 40
    again = digests.reconcile_by_ranges(frames[0], frames[0], "job_id", ["job_id", "status"], 100)[1].first()
    assert (again.ranges, again.read_again) == (0, 0)


def test_changes_behind_a_cursor_are_found_in_turn(spark):
    rows = spark.range(2_000).select(F.col("id").alias("job_id"), F.lit("old").alias("status"))
    stored = digests.range_digests(rows, "job_id", 100, rows.columns)
    moved = rows.withColumn("status", F.when(F.col("job_id").isin(5, 250, 1999), "new").otherwise(F.col("status"))).filter("job_id <> 777")
    found = set()
    for turn in range(4):
        part = digests.changed_rows(moved, stored, "job_id", 100, rows.columns, F.pmod("range", F.lit(4)) == turn).collect()
        assert not found & {r.job_id for r in part}
        found |= {r.job_id for r in part}
    assert found == {i for i in range(2_000) if i // 100 in (0, 2, 7, 19)} - {777}
