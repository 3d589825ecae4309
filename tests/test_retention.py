"""Retention rules: ages, orphans, presence, plausibility, delete-time checks."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from telemill.operators import retention
from telemill.plans import jobs
from telemill.plans.lake import Lake
from telemill.session import scratch

CUTOFF = datetime(2026, 1, 1)
OLD, YOUNG = datetime(2020, 1, 1), datetime(2030, 1, 1)


def parents(spark, rows):
    return spark.createDataFrame(rows, "job_id long, last_update timestamp_ntz")


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "job_id long")


def traces(spark, rows):
    return spark.createDataFrame(rows, "job_id long, laststatuschangetimestamp long")


def keys(df):
    return sorted(r.job_id for r in df.collect())


def test_strict_bounds_and_nulls(spark):
    rows = parents(spark, [(1, CUTOFF), (2, CUTOFF - timedelta(microseconds=1)), (3, None)])
    assert keys(retention.old_jobs(rows, CUTOFF)) == [2]
    ms = retention.millis(CUTOFF)
    assert keys(retention.old_traces(traces(spark, [(1, ms), (2, ms - 1), (3, None)]), CUTOFF)) == [2]
    assert retention.millis(CUTOFF + timedelta(microseconds=1)) == ms + 1


def test_age_reaches_the_file_scan(spark, tmp_path):
    traces(spark, [(i, i) for i in range(10)]).write.parquet(str(tmp_path / "t"))
    plan = retention.old_traces(spark.read.parquet(str(tmp_path / "t")), CUTOFF)
    assert "LessThan(laststatuschangetimestamp," in plan._jdf.queryExecution().executedPlan().toString()


ORPHANS = [
    ([(2, OLD), (3, YOUNG)], [1, 2, 3], [1, 2]),
    ([(100, YOUNG)], [150], []),
    ([(100, YOUNG)], [50], [50]),
    ([(100, YOUNG)], [150, 50], [50]),
    ([], [1], []),
    ([(5, None)], [5, 4], [4]),
]


@pytest.mark.parametrize("rows, children, expected", ORPHANS)
def test_orphan_rule(spark, rows, children, expected):
    got = retention.old_jdls(ids(spark, children * 3), parents(spark, rows), CUTOFF)
    assert keys(got) == expected


def test_orphan_rule_with_a_null_parent_id(spark):
    got = retention.old_jdls(ids(spark, [50]), parents(spark, [(100, YOUNG), (None, YOUNG)]), CUTOFF)
    assert keys(got) == [50]


def test_presence_partitions_the_candidates(spark):
    checked = retention.presence(ids(spark, range(10)), ids(spark, [1, 1, 3, 99])).collect()
    assert {r.job_id for r in checked if r.verified} == {1, 3}
    assert len(checked) == 10


@pytest.mark.parametrize(
    "moment, passes",
    [(datetime(1970, 1, 21), False), (datetime(2020, 1, 1), True), (datetime(2035, 1, 1), False), (None, True)],
)
def test_plausibility(spark, moment, passes):
    rows = traces(spark, [] if moment is None else [(1, retention.millis(moment))])
    assert retention.plausibility(rows, ids(spark, [1])).collect()[0].plausible is passes


def stored(spark, job_rows, trace_rows, jdl_ids, held):
    landing, lake = Lake(spark, scratch(spark, "landing")), Lake(spark, scratch(spark, "lake"))
    landing.upsert("job_info", parents(spark, job_rows))
    landing.upsert("trace", traces(spark, trace_rows))
    landing.append("mon_jdls", ids(spark, jdl_ids))
    for table in ("job_info", "trace", "mon_jdls_parsed"):
        lake.upsert(table, ids(spark, held))
    return landing, lake


def verdict(df):
    return {r.table: (r.kept, r.deleted, r.unverified, r.exit_code) for r in df.collect()}


def test_interleaved_ages_delete_in_both_tables(spark):
    old, young = range(10, 15), [1, 2, 20, 21, 22]
    rows = [(i, OLD) for i in old] + [(i, YOUNG) for i in young]
    landing, lake = stored(spark, rows, [(1, retention.millis(YOUNG))], [*old, *young], [*old, *young])
    got = verdict(jobs.run_retention(landing, lake, CUTOFF, days=0))
    assert got["job_info"] == (0, 5, 0, 0) and got["mon_jdls"] == (0, 5, 0, 0)
    assert keys(landing.read("mon_jdls")) == sorted(young)


def test_unverified_key_is_kept_and_fails_the_run(spark):
    landing, lake = stored(spark, [(1, OLD), (2, OLD)], [(9, retention.millis(YOUNG))], [7], [1])
    report = jobs.run_retention(landing, lake, CUTOFF, days=0)
    assert verdict(report)["job_info"] == (1, 1, 1, 1)
    assert jobs.exit_code(report) == 1
    assert keys(landing.read("job_info")) == [2]


def test_a_job_that_revives_survives(spark):
    landing, lake = stored(
        spark, [(1, OLD), (2, OLD), (3, YOUNG)], [(9, retention.millis(YOUNG))], [1, 2, 3], [1, 2, 3]
    )
    frozen = {t: landing.head(t).snapshot_id for t in ("job_info", "trace", "mon_jdls")}
    landing.upsert("job_info", parents(spark, [(1, YOUNG)]))
    got = verdict(jobs.run_retention(landing, lake, CUTOFF, days=0, frozen=frozen))
    assert got["job_info"][1] == 1 and got["mon_jdls"][1] == 1
    assert keys(landing.read("job_info")) == [1, 3] and keys(landing.read("mon_jdls")) == [1, 3]


def test_implausible_times_abort_before_any_delete(spark):
    landing, lake = stored(spark, [(1, OLD)], [(1, 1_783_848_905)], [1], [1])
    report = jobs.run_retention(landing, lake, CUTOFF, days=0)
    assert jobs.exit_code(report) == 1 and verdict(report) == {"abort": (0, 0, 0, 1)}
    assert landing.read("job_info").count() == landing.read("trace").count() == 1
