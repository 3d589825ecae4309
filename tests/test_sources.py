"""Cursors, dump files and times."""

from __future__ import annotations

import json
import lzma
from datetime import datetime

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from telemill.functions.moments import parse_utc
from telemill.plans import jobs
from telemill.plans.lake import Lake
from telemill.session import scratch
from telemill.sources import cursors, dumps

LISTING = """<a href="/">Up To</a>
<a href="/download/site-sonar-1702260001.out.xz">a</a>
<a href="site-sonar-1783803541.out.xz">b</a>
<a href="http://other.example/site-sonar-1743199141.out.xz">c</a>
<a href="site-sonar-x.out.xz">no</a>"""


def test_listing(spark):
    pages = spark.createDataFrame([("http://h.example/d/", LISTING)], "base_url string, html string")
    assert {tuple(r) for r in dumps.list_dumps(pages).collect()} == {
        (1702260001, "http://h.example/download/site-sonar-1702260001.out.xz"),
        (1783803541, "http://h.example/d/site-sonar-1783803541.out.xz"),
        (1743199141, "http://other.example/site-sonar-1743199141.out.xz"),
    }


def probe(i: int) -> str:
    doc = {"host_id": i, "hostname": f"wn{i}", "ce_name": "c", "addr": "a", "last_updated": 100 + i,
           "test_results_json": {"os": {"NAME": "x", "EXITCODE": i % 3}, "gpus": ["a", "b"]}}
    return json.dumps(doc)


def lines_of(spark, content: bytes):
    frame = spark.createDataFrame([("f", bytearray(content))], "path string, content binary")
    return dumps.dump_lines(frame)


def test_reader_skips_only_bad_lines(spark):
    body = "\n".join([probe(1), "<html>502 bad gateway</html>", '{"host_id": 12, "addr":', "", "   ", probe(2) + "\r", "[1]", probe(3)])
    lines = lines_of(spark, lzma.compress(body.encode()))
    assert sorted(r.host_id for r in dumps.probe_rows(lines).collect()) == [1, 2, 3]
    report = dumps.line_report(lines).collect()[0]
    assert (report.lines, report.good, report.skipped) == (6, 3, 3)


def test_reader_handles_streams_sizes_and_bad_bytes(spark):
    many = "\n".join(probe(i) for i in range(60_000))
    content = lzma.compress(many.encode()) + lzma.compress(b"\n" + b'{"hostname": "\xff"}') + b"\0\0\0\0"
    rows = dumps.probe_rows(lines_of(spark, content))
    assert rows.count() == 60_001
    assert rows.filter("hostname = '�'").count() == 1
    assert lines_of(spark, lzma.compress(b"")).count() == 0


def test_truncated_file_fails_the_job(spark):
    content = lzma.compress(("\n".join(probe(i) for i in range(1000))).encode())
    with pytest.raises(PythonException, match="truncated|LZMAError"):
        lines_of(spark, content[: len(content) // 2]).count()


def test_child_rows_of_a_list(spark):
    probes = dumps.probe_rows(lines_of(spark, lzma.compress(probe(7).encode())))
    got = [tuple(r) for r in dumps.test_children(probes, "$.gpus").collect()]
    assert got == [("wn7", 107, 0, "a"), ("wn7", 107, 1, "b")]


def test_choice_of_files(spark):
    files = spark.createDataFrame([(e, f"u{e}") for e in (300, 250, 200)], "epoch long, url string")

    def chosen(mark, **how):
        return [r.epoch for r in dumps.take_files(dumps.newer_than(files, mark), **how).collect()]

    assert sorted(chosen(0)) == [200, 250, 300]
    assert sorted(chosen(200)) == [250, 300]
    assert chosen(300) == []
    assert chosen(200, limit=1, order="newest") == [300]
    assert chosen(200, limit=1) == [250]
    assert dumps.next_mark(files.filter("epoch = 0"), 40).collect()[0].mark == 40


def test_dump_job_reads_each_file_once(spark, tmp_path):
    for epoch in (100, 200, 300):
        name = tmp_path / f"site-sonar-{epoch}.out.xz"
        name.write_bytes(lzma.compress("\n".join(probe(epoch + i) for i in range(5)).encode()))
    lake = Lake(spark, scratch(spark, "dumps"))
    files = dumps.dump_files(spark, str(tmp_path))
    first = jobs.run_dumps(lake, files, "r1", limit=2).collect()[0]
    assert (first.listed, first["read"], first.mark_before, first.mark_after) == (3, 2, 0, 200)
    second = jobs.run_dumps(lake, files, "r2").collect()[0]
    assert (second["read"], second.mark_after) == (1, 300)
    assert jobs.run_dumps(lake, files, "r3").collect()[0]["read"] == 0
    assert lake.read("site_sonar").count() == 15
    assert lake.cursor("site_sonar") == "300,404"


def test_late_rows_are_left_out_after_the_first_run(spark, tmp_path):
    lake = Lake(spark, scratch(spark, "dumps"))

    def run(epoch, ids, run_id, **how):
        name = tmp_path / f"site-sonar-{epoch}.out.xz"
        name.write_bytes(lzma.compress("\n".join(probe(i) for i in ids).encode()))
        jobs.run_dumps(lake, dumps.dump_files(spark, str(tmp_path)), run_id, **how)
        return sorted(r.host_id for r in lake.read("site_sonar").collect())

    assert run(1, [5, 1], "a") == [1, 5]
    assert run(2, [4, 5, 9], "b") == [1, 5, 5, 9]
    assert run(3, [2], "c") == [1, 5, 5, 9]
    assert run(4, [2], "d", drop_late=False) == [1, 2, 5, 5, 9]
    assert lake.cursor("site_sonar") == "4,109"


def test_start_values():
    job = cursors.CURSORS["job_info"]
    assert cursors.start_value(job, None) == "2026-01-01T00:00:00"
    assert cursors.start_value(job, None, "2026-03-01") == "2026-03-01T00:00:00"
    assert cursors.start_value(job, "2026-05-01T00:00:00", "2026-03-01") == "2026-05-01T00:00:00"
    assert cursors.start_value(cursors.CURSORS["trace"], None, "17") == "17"
    with pytest.raises(ValueError, match="offset"):
        cursors.checked_start("naive", "2026-03-01T00:00:00+02:00")
    with pytest.raises(ValueError):
        cursors.checked_start("integer", "soon")


def test_cursor_reaches_the_file_scan(spark, tmp_path):
    rows = spark.range(100).selectExpr(
        "id AS job_id", "id * 1000 AS ms", "timestamp_ntz'2026-01-01' + make_dt_interval(cast(id AS int)) AS at"
    )
    rows.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    for column, kind, value in (("ms", "integer", "50000"), ("at", "naive", "2026-02-20T00:00:00")):
        found = cursors.since(table, column, kind, value)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert f"GreaterThanOrEqual({column}," in plan
        assert found.count() == 50


def test_jdbc_options_split_on_the_key():
    options = cursors.jdbc_options("jdbc:x", "mon_jdls", 0, 1000, 8)
    assert options["fetchsize"] == "20000" and options["partitionColumn"] == "job_id"
    assert "numPartitions" not in cursors.jdbc_options("jdbc:x", "trace")


def test_utc_text(spark):
    df = spark.createDataFrame([("2026-07-12 19:40:03.327 UTC",), ("2026-07-12 19:40:03.327 CET",), ("x UTC",), (None,)], "t string")
    got = [r[0] for r in df.select(parse_utc(F.col("t")).cast("timestamp_ntz")).collect()]
    assert got == [datetime(2026, 7, 12, 19, 40, 3, 327000), None, None, None]


def test_a_limit_takes_whole_epochs(spark):
    files = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "epoch bigint, url string")
    first = dumps.take_files(files, 1)
    assert sorted(r.url for r in first.collect()) == ["a", "b"]
    mark = first.agg({"epoch": "max"}).first()[0]
    assert [r.url for r in dumps.take_files(dumps.newer_than(files, mark), 1).collect()] == ["c"]
    assert [r.url for r in dumps.take_files(files, 1, "newest").collect()] == ["c"]


def test_bounds_of_a_parallel_scan():
    assert cursors.bounds_query("trace", "job_id", "integer", "7").startswith("(SELECT min(job_id) AS lo")
    assert "last_update >= TIMESTAMP '1996-01-01 00:00:00'" in cursors.bounds_query("job_info", "last_update", "naive", "1996-01-01T00:00:00")
    split = cursors.split_of(10, 1009, 8)
    options = cursors.jdbc_options("jdbc:x", "trace", **split)
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("10", "1010", "8")
    assert cursors.split_of(None, None, 8) == cursors.split_of(3, 3, 8) == {}
