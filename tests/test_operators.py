"""Time lines, drift, freshness and rules against brute force."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from telemill import contract
from telemill.operators import probes, quality, rules, timeline
from telemill.operators.drift import contract_rows, drift, drift_verdict
from telemill.plans import lake
from telemill.streaming import ingest


@pytest.mark.parametrize("bucket, split", [(7, 1_000_000), (1000, 1_000_000), (1000, 10), (50, 3)])
def test_asof_equals_brute_force_with_a_hot_host(spark, bucket, split):
    rng = random.Random(bucket)
    hosts = ["hot"] * 6 + ["a", "b", None]
    facts = [(i, rng.choice(hosts), rng.randrange(200) if rng.random() < 0.95 else None) for i in range(400)]
    found = [(rng.choice(hosts), rng.randrange(200), i) for i in range(150)]
    f = spark.createDataFrame(facts, "id long, host string, at long")
    p = spark.createDataFrame(found, "host string, seen long, n long")
    got = {r.id: (r.probe_seen, r.n) for r in timeline.asof_join(f, p, "host", "at", "seen", ["n"], bucket, split).collect()}
    assert len(got) == len(facts)
    for i, host, at in facts:
        before = [(s, n) for h, s, n in found if host is not None and h == host and at is not None and s < at]
        assert got[i] == (max(before) if before else (None, None)), (i, host, at)


def test_units_of_the_probe_join(spark):
    trace = spark.createDataFrame([(1, "wn1", 5_000), (2, "wn1", 5_001)], "job_id long, host string, startedtimestamp long")
    seen = spark.createDataFrame([("wn1", 5, "x"), ("wn1", 4, "y")], "hostname string, last_updated long, os string")
    got = {r.job_id: r.os for r in probes.host_at_start(trace, seen, ["os"]).collect()}
    assert got == {1: "y", 2: "x"}


@pytest.mark.parametrize("bucket", [3, 100])
def test_counter_increase_equals_brute_force(spark, bucket):
    rng = random.Random(3)
    rows = sorted({(rng.choice("aab"), t) for t in rng.sample(range(90), 60)})
    rows = [(s, t, rng.randrange(20)) for s, t in rows]
    df = spark.createDataFrame(rows, "s string, t long, v long")
    got = {(r.s, r.t): r.increase for r in timeline.counter_increase(df, "s", "t", "v", bucket).collect()}
    last: dict = {}
    for s, t, v in sorted(rows):
        want = None if s not in last else (v - last[s] if v >= last[s] else v)
        assert got[(s, t)] == want
        last[s] = v


def live(spark, *extra, without=()):
    rows = [
        (table.name, column, "string")
        for table in contract.TABLES.values()
        for column in table.selected
        if column not in without
    ]
    return spark.createDataFrame(rows + list(extra), "table string, column string, type string")


def kinds(spark, frame):
    got = drift(frame, contract_rows(spark, contract.TABLES.values()))
    verdicts = {s: drift_verdict(got, s).collect()[0] for s in (False, True)}
    return {(r.column, r.kind) for r in got.collect()}, verdicts


def test_drift_directions_and_codes(spark):
    exact, verdict = kinds(spark, live(spark))
    assert exact == set() and verdict[True].exit_code == 0
    extra, verdict = kinds(
        spark, live(spark, ("mon_jdls_parsed", "jdl__x", "string"), ("trace", "note", "int"), ("trace", "_dlt_id", "string"),
                    ("elsewhere", "jdl__y", "string"))
    )
    assert extra == {("jdl__x", "additive"), ("note", "informational")}
    assert (verdict[False].exit_code, verdict[True].exit_code, verdict[True].applied) == (0, 2, True)
    for column in ("jdl__ttl", "jdl__nkeep"):
        missing, verdict = kinds(spark, live(spark, without=(column,)))
        assert missing == {(column, "subtractive")}
        assert verdict[False].exit_code == verdict[True].exit_code == 2 and not verdict[False].applied


def test_projection_keeps_case_and_avoids_the_one_collision(spark):
    columns = [c for c in contract.MON_JDLS_PARSED.selected]
    df = spark.createDataFrame([tuple(str(i) for i in range(len(columns)))], columns)
    view = contract.project(df, contract.MON_JDLS_PARSED)
    assert len({c.lower() for c in view.columns}) == len(view.columns) == 111
    assert view.columns[1] == "Activity" and "_src_lpmjobtypeid" in view.columns
    assert view.schema["HardBins"].dataType.simpleString() == "string"
    assert view.collect()[0].HardBins is None
    with pytest.raises(ValueError):
        contract.project(df, contract.ContractTable("none", {}))


NOW = datetime(2026, 7, 13, 12, tzinfo=timezone.utc)


@pytest.mark.parametrize(
    "commits, stale",
    [
        ([(1, "append")], False),
        ([(48, "append"), (1, "replace")], True),
        ([(48, "append"), (2, "append"), (1, "replace")], False),
        ([], True),
        ([(26, "append")], False),
        ([(27, "append")], True),
        ([(1, "replace")], True),
    ],
)
def test_freshness(spark, commits, stale):
    rows = [("t", NOW - timedelta(hours=h), op) for h, op in commits]
    log = spark.createDataFrame(rows, "table string, committed_at timestamp, operation string")
    expected = spark.createDataFrame([("t",)], "table string")
    assert quality.freshness(log, expected, F.lit(NOW)).collect()[0].stale is stale


def test_reconcile_counts_duplicates(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c")], "k long, v string")
    right = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d")], "k long, v string")
    got = {r.verdict: r["keys"] for r in quality.reconcile(left, right, "k", ["v"]).collect()}
    assert got == {"changed": 1, "same": 1, "missing": 1, "extra": 1}


def test_absence(spark):
    rows = [("nightly", NOW - timedelta(hours=25)), ("dumps", NOW - timedelta(hours=26))]
    runs = spark.createDataFrame(rows, "name string, event_time timestamp")
    plan = spark.createDataFrame(list(rules.MAX_GAP_HOURS.items()), "name string, max_gap_hours int")
    got = {r.name: r.absent for r in rules.absent(plan, runs, F.lit(NOW)).collect()}
    assert got == {"nightly": False, "dumps": True, "maintenance": True}


def test_hold_time_needs_an_unbroken_run(spark):
    start = int(NOW.timestamp())
    values = [5, 5, 1, 5, 5, 5, 5]
    rows = [("ns", "db", float(v), NOW + timedelta(minutes=10 * i)) for i, v in enumerate(values)]
    rows += [("ns", "db", 0.0, r[3]) for r in rows]
    gauges = spark.createDataFrame(rows, "namespace string, job string, value double, event_time timestamp")
    got = rules.gauge_breaches(gauges, 600, 1800, F.col("top") > 4).collect()
    assert [(r.start_s, r.end_s, r.steps) for r in got] == [(start + 1800, start + 3600, 4)]


def test_orphan_rule_for_files(spark):
    old, young = NOW - timedelta(days=8), NOW - timedelta(days=1)
    stored = spark.createDataFrame(
        [("t", "f1", "a", old), ("t", "f2", "b", old), ("t", "f2", "c", young)],
        "table string, folder string, path string, modified_at timestamp",
    )
    named = spark.createDataFrame([("t", "f1")], "table string, path string")
    got = lake.orphan_files(stored, named, NOW - timedelta(days=7)).collect()
    assert [r.path for r in got] == ["b"]


def test_streamed_failures_equal_the_batch_rule(spark, tmp_path):
    rng = random.Random(5)
    rows = [
        (f"w{i % 2}", rng.choice(["Failed", "Error", "Succeeded"]), (NOW + timedelta(minutes=i * 7)).replace(tzinfo=None))
        for i in range(120)
    ]
    runs = spark.createDataFrame(rows, "name string, phase string, event_time timestamp_ntz")
    runs.repartitionByRange(3, "event_time").write.parquet(str(tmp_path / "in"))
    failed = F.col("phase").isin(*rules.FAILED)
    batch = rules.increase_over(rules.step_counts(runs, 3600, failed), 6 * 3600, 3600, 1)
    stream = ingest.file_stream(spark, str(tmp_path / "in"), runs.schema)
    counted = ingest.failure_windows(stream, failed, "6 hours", "1 hour", "1 hour")
    query = counted.writeStream.outputMode("complete").format("memory").queryName("failures").trigger(availableNow=True)
    query.start().awaitTermination()
    got = {(r.name, r["at"], r.increase) for r in spark.table("failures").select("name", F.col("at").cast("timestamp_ntz").alias("at"), "increase").collect()}
    assert got == {(r.name, r["at"], r.increase) for r in batch.collect()}


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    from telemill.operators.keys import latest_per_key

    rows = spark.range(20_000).selectExpr("if(id % 3 = 0, 0, id) AS job_id", "id AS c", "'x' AS v")
    best = latest_per_key(rows, "job_id", "c")
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert best.filter("job_id = 0").collect()[0].c == 19_998
    assert best.count() == rows.select("job_id").distinct().count()
