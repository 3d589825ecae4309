"""Table writes, versions, state, upkeep."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from hashlib import md5
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from telemill.operators.drift import SchemaFrozenError
from telemill.plans import jobs
from telemill.plans.lake import CommitConflictError, Lake, NullKeyError
from telemill.session import scratch
from telemill.sources import generator
from telemill.sources.generator import job_info_rows, mon_jdls_rows, trace_rows


@pytest.fixture()
def lake(spark):
    return Lake(spark, scratch(spark, "lake"), width=100)


def frame(spark, rows, columns="job_id long, v string, c long"):
    return spark.createDataFrame(rows, columns)


def content(lake, table="t", **at):
    return sorted(tuple(r) for r in lake.read(table, **at).collect())


def test_merge_updates_inserts_and_keeps(spark, lake):
    lake.upsert("t", frame(spark, [(i, "old", i) for i in range(250)]), cursor=("c", "integer"))
    lake.upsert("t", frame(spark, [(10, "new", 300), (600, "new", 301)]), cursor=("c", "integer"))
    got = {k: v for k, v, _ in content(lake)}
    assert len(got) == 251 and got[10] == "new" and got[600] == "new" and got[11] == "old"
    assert lake.cursor("t") == "301"
    first, second = (r.parts for r in lake.commits().orderBy("sequence_number").collect())
    untouched = {p.path for p in first if p.bucket in (1, 2)}
    assert untouched <= {p.path for p in second}
    assert [r.total_records for r in lake.commits().orderBy("sequence_number").collect()] == [250, 251]


def test_one_row_per_key_highest_cursor_wins(spark, lake):
    lake.upsert("t", frame(spark, [(1, "a", 5), (1, "b", 7), (1, "c", None)]), cursor=("c", "integer"))
    assert content(lake) == [(1, "b", 7)]


def test_empty_merge_commits_nothing(spark, lake):
    assert lake.upsert("t", frame(spark, [])) is None
    lake.upsert("t", frame(spark, [(1, "a", 1)]))
    assert lake.upsert("t", frame(spark, [])) is None
    assert lake.commits().count() == 1


def test_rows_without_a_key_are_refused(spark, lake):
    with pytest.raises(NullKeyError):
        lake.upsert("t", frame(spark, [(None, "a", 1), (2, "b", 1)]))
    assert not lake.exists("t")


def test_types_freeze_and_columns_evolve(spark, lake):
    lake.upsert("t", frame(spark, [(1, "a", 1)]))
    with pytest.raises(SchemaFrozenError, match="c: bigint -> string"):
        lake.upsert("t", frame(spark, [(1, "a", "1")], "job_id long, v string, c string"))
    lake.upsert("t", frame(spark, [(2, "b", 1, True)], "job_id long, v string, c long, n boolean"))
    assert content(lake) == [(1, "a", 1, None), (2, "b", 1, True)]


def test_time_travel_by_version_and_time(spark, lake):
    day = datetime(2026, 1, 1, tzinfo=timezone.utc)
    one = lake.upsert("t", frame(spark, [(1, "a", 1)]), committed_at=day)
    lake.upsert("t", frame(spark, [(1, "b", 2)]), committed_at=day + timedelta(days=2))
    assert content(lake, snapshot_id=one) == [(1, "a", 1)]
    assert content(lake, as_of=day + timedelta(days=1)) == [(1, "a", 1)]
    assert content(lake) == [(1, "b", 2)]
    with pytest.raises(LookupError):
        lake.read("t", as_of=day - timedelta(days=1))


def test_second_writer_of_a_version_fails(spark, lake):
    lake.upsert("t", frame(spark, [(1, "a", 1)]))
    head = lake.head("t")
    schema = lake.read("t").schema
    lake._commit("t", head, "append", list(head.parts), schema)
    with pytest.raises(CommitConflictError):
        lake._commit("t", head, "append", list(head.parts), schema)


def test_append_is_fenced_by_run(spark, lake):
    rows = frame(spark, [(1, "a", 1)])
    assert lake.append("t", rows, run_id="x") is not None
    assert lake.append("t", rows, run_id="x") is None
    lake.append("t", rows, run_id="y")
    assert lake.read("t").count() == 2


def test_delete_reports_rows(spark, lake):
    lake.append("t", frame(spark, [(1, "a", 1), (1, "b", 2), (2, "c", 3)]))
    assert lake.delete("t", frame(spark, [(1, "", 0), (9, "", 0)])) == 2
    assert lake.delete("t", frame(spark, [(9, "", 0)])) == 0
    assert content(lake) == [(2, "c", 3)]
    assert lake.commits().count() == 2


def test_upkeep_keeps_rows_and_cursor(spark, lake):
    old = datetime(2026, 1, 1, tzinfo=timezone.utc)
    for day in range(5):
        lake.append("t", frame(spark, [(day, "a", day)]), cursor=("epoch", str(day)) if day == 1 else None,
                    committed_at=old + timedelta(days=day))
    before = content(lake)
    lake.compact("t", committed_at=old + timedelta(days=6))
    assert content(lake) == before
    assert lake.head("t").operation == "replace"
    report = lake.expire(old + timedelta(days=30)).collect()[0]
    # the head and the row with the newest cursor stay
    assert (report.versions_before, report.versions_after, report.expired) == (6, 2, 4)
    assert lake.cursor("t") == "1" and content(lake) == before
    assert lake.orphans(datetime.now(timezone.utc) - timedelta(days=1)).count() == 0
    gone = lake.remove_orphans(datetime.now(timezone.utc) + timedelta(days=1))
    assert gone > 0 and content(lake) == before


def test_expiry_never_drops_the_head(spark, lake):
    lake.append("t", frame(spark, [(1, "a", 1)]), committed_at=datetime(2020, 1, 1, tzinfo=timezone.utc))
    assert lake.expire(datetime(2026, 1, 1, tzinfo=timezone.utc)).collect()[0].expired == 0
    assert lake.read("t").count() == 1


def test_empty_namespace(spark, lake):
    now = datetime.now(timezone.utc)
    assert jobs.run_maintenance(lake, now).count() == 0
    assert jobs.run_upkeep(lake, now).count() == 0
    assert jobs.exit_code(jobs.check_freshness(lake, now)) == 1


def test_reset_needs_confirmation(spark, lake):
    lake.append("t", frame(spark, [(1, "a", 1)]), cursor=("epoch", "5"))
    with pytest.raises(ValueError):
        lake.reset()
    lake.reset(confirm=True)
    assert lake.cursor("t") is None and lake.tables().count() == 0


def drawn(name, job, span):
    return int(md5(f"{name}:{job}".encode()).hexdigest()[:8], 16) % span


def test_nightly_contract_export_and_replay(spark):
    landing, lake = Lake(spark, scratch(spark, "landing"), 300), Lake(spark, scratch(spark, "lake"), 300)
    ids = spark.range(1, 1001).withColumnRenamed("id", "job_id")
    now = F.lit("2026-07-15T00:00:00").cast("timestamp_ntz")
    landing.upsert("job_info", job_info_rows(ids, now))
    landing.upsert("trace", trace_rows(ids, now))
    landing.upsert("mon_jdls", mon_jdls_rows(ids))
    source = {name: landing.read(name) for name in ("job_info", "trace", "mon_jdls")}
    jobs.run_nightly(lake, source, "n1")
    parsed = lake.read("mon_jdls_parsed")
    odd = [job for job in range(1, 1001) if drawn("oddness", job, generator.ODD_IN) < 2]
    assert odd
    assert parsed.count() == 1000 and len(parsed.columns) == 109
    assert "jdl__lpm_pass_name" in parsed.columns and "jdl__lpmpassname" not in parsed.columns
    assert [r.job_id for r in parsed.filter("not jdl_parse_ok").orderBy("job_id").collect()] == odd
    assert parsed.filter("jdl__lpm_pass_name is null").count() == len(odd)
    kinds = {f.dataType.simpleString() for f in parsed.schema if f.name.startswith("jdl__")}
    assert kinds == {"string"}
    before = parsed.drop("_dlt_load_id", "_dlt_id").collect()
    jobs.run_nightly(lake, source, "n2")
    after = lake.read("mon_jdls_parsed").drop("_dlt_load_id", "_dlt_id").collect()
    assert sorted(before, key=str) == sorted(after, key=str)
    verdict, views = jobs.publish_contract(lake, strict=True)
    assert jobs.exit_code(verdict) == 0 and len(views["mon_jdls_parsed"].columns) == 111
    out = scratch(spark, "out")
    rows = {r.table: r for r in jobs.run_export(lake, out, datetime(2026, 7, 15, tzinfo=timezone.utc)).collect()}
    assert {r.row_count for r in rows.values()} == {1000}
    assert rows["trace"].extracted_at == "2026-07-15T00:00:00Z" and rows["trace"].fallback_reason is None
    assert rows["trace"].snapshot_id == lake.head("trace").snapshot_id
    assert spark.read.parquet(f"{out}/mon_jdls_parsed.parquet").count() == 1000
    assert spark.read.json(f"{out}/manifest.json").count() == 3
    # a job's last change is its age less the stretches of its life
    settled = lambda job: sum(drawn(n, job, span) for n, span in generator.STRETCHES.items()) - drawn("age", job, generator.MAX_AGE_DAYS * 86_400)
    old = sum(settled(job) < -14 * 86_400 for job in range(1, 1001))
    result = {r.table: r for r in jobs.run_retention(landing, lake, datetime(2026, 7, 15)).collect()}
    assert [result[t].deleted for t in ("job_info", "trace", "mon_jdls", "total")] == [old, old, old, 3 * old]
    assert landing.read("mon_jdls").count() == 1000 - old


def test_a_new_jdl_key_becomes_a_column_and_is_reported(spark):
    lake = Lake(spark, scratch(spark, "lake"))
    ids = spark.range(1, 11).withColumnRenamed("id", "job_id")
    now = F.lit("2026-07-15T00:00:00").cast("timestamp_ntz")
    source = {
        "job_info": job_info_rows(ids, now), "trace": trace_rows(ids, now), "mon_jdls": mon_jdls_rows(ids),
    }
    jobs.run_nightly(lake, source, "n1")
    new = ids.select("job_id", F.lit("x").alias("lpmjobtypeid"), F.lit('{"BrandNew": [1]}').alias("full_jdl"))
    jobs.run_nightly(lake, source | {"mon_jdls": new}, "n2")
    assert "jdl__brand_new" in lake.read("mon_jdls_parsed").columns
    assert jobs.exit_code(jobs.publish_contract(lake)[0]) == 0
    assert jobs.exit_code(jobs.publish_contract(lake, strict=True)[0]) == 2


def test_merge_keeps_every_folder_of_a_bucket(spark):
    lake = Lake(spark, scratch(spark, "lake"))
    for start in (0, 10, 20):
        lake.append("t", frame(spark, [(start + i, "a", 1) for i in range(10)]))
    lake.upsert("t", frame(spark, [(5, "b", 2), (10**9, "c", 2)]))
    got = {k: v for k, v, _ in content(lake)}
    assert len(got) == len(content(lake)) == 31 and got[5] == "b"
    lake.append("t", frame(spark, [(40, "d", 1), (-40, "d", 1)]))
    lake.upsert("t", frame(spark, [(40, "e", 1), (-40, "e", 1)]))
    assert len(content(lake)) == 33 and {v for k, v, _ in content(lake) if abs(k) == 40} == {"e"}


def test_upkeep_keeps_the_layout_of_a_keyed_table(spark):
    lake = Lake(spark, scratch(spark, "lake"))
    first = 3_593_645_502
    for half in (0, 1):
        lake.upsert("own", frame(spark, [(first + i, "a", 1) for i in range(half, 50, 2)]))
    jobs.run_upkeep(lake, datetime(2100, 1, 1, tzinfo=timezone.utc))
    lake.upsert("own", frame(spark, [(first + i, "b", 1) for i in range(5)]))
    assert len(content(lake, "own")) == 50


def test_a_root_with_a_data_segment_keeps_its_files(spark):
    lake = Lake(spark, scratch(spark, "x") + "/data/lake")
    lake.append("t", frame(spark, [(i, "a", 1) for i in range(10)]))
    assert lake.orphans(datetime(2100, 1, 1, tzinfo=timezone.utc)).count() == 0
    assert lake.current_files().collect()[0].files >= 1
    jobs.run_upkeep(lake, datetime(2100, 1, 1, tzinfo=timezone.utc))
    assert len(content(lake)) == 10


def test_a_dead_writer_blocks_nobody(spark, lake):
    lake.append("t", frame(spark, [(1, "a", 1)]))
    Path(f"{lake.root}/commits/table=t/sequence_number=2/_temporary".removeprefix("file:")).mkdir(parents=True)
    lake.append("t", frame(spark, [(2, "a", 1)]))
    assert len(content(lake)) == 2 and lake.head("t").sequence_number == 2


def test_one_large_file_does_not_hide_small_ones(spark, lake):
    big = spark.range(200_000).selectExpr("id AS job_id", "sha2(cast(id as string), 256) AS v", "id AS c").coalesce(1)
    lake.append("t", big)
    for i in range(3):
        lake.append("t", frame(spark, [(i, "a", 1)]))
    assert lake.compact("t", small=1 << 20) is not None
    assert lake.read("t").count() == 200_003 and lake.compact("t", small=1 << 20) is None
