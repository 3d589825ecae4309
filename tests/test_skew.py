"""Hot keys, Bloom pre-pass and alerts as streams."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from telemill.operators import membership, retention, timeline
from telemill.plans.queries_skew import _fed
from telemill.plans.domain import Given
from telemill.streaming import alerts


def test_bloom_filter_leaves_out_no_key(spark):
    small = spark.range(3000).select((F.col("id") * 97 - 50_000).alias("job_id"))
    large = spark.range(-100_000, 300_000).select(F.col("id").alias("job_id"), F.lit("x").alias("bits")).unionByName(
        spark.createDataFrame([(None, "x")], "job_id bigint, bits string")
    )
    kept = membership.pruned(large, small, "job_id")
    assert kept.columns == large.columns
    assert kept.join(small, "job_id", "left_semi").count() == large.join(small, "job_id", "left_semi").count() == 3000
    assert kept.count() < 3000 + 0.1 * large.count()  # few others get through
    assert membership.pruned(large, small, "job_id", most_words=10) is large
    assert membership.pruned(large, small.limit(0), "job_id").count() == 0
    want = sorted(map(tuple, retention.presence(small, large.select("job_id").filter("job_id % 2 = 0")).collect()))
    assert sorted(map(tuple, membership.presence_pruned(small, large.filter("job_id % 2 = 0")).collect())) == want



def test_one_series_spreads_over_tasks(spark):
    r = random.Random(4)
    rows = [("hot", r.randint(0, 5_000), r.choice([None, *range(40)])) for _ in range(4_000)]
    rows += [(r.choice(["a", "b", None]), r.randint(0, 50), r.randint(0, 9)) for _ in range(300)]
    df = spark.createDataFrame(rows, "s string, t bigint, v bigint").repartition(6)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        got = timeline.counter_increase_by_ranges(df, "s", "t", "v")
        assert df.repartitionByRange("s", "t", "v").filter("s = 'hot'").select(F.spark_partition_id()).distinct().count() >= 5
        rows_of = lambda frame: sorted(map(tuple, frame.select("s", "t", "v", "increase").collect()), key=repr)
        found = rows_of(got)
    finally:
        spark.conf.unset(key)
    want, before = [], {}
    for s, t, v in sorted(rows, key=lambda x: (x[0] is not None, x[0] or "", x[1], x[2] is not None, x[2] or 0)):
        last = before.get(s)
        want.append((s, t, v, None if last is None or v is None else v - last if v >= last else v))
        before[s] = v
    assert found == sorted(want, key=repr)


def test_hot_groups_are_known_before_the_facts_move(spark):
    facts = spark.range(40_000).select(F.col("id"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("h"), F.col("id") % 500)).alias("host"), (F.col("id") % 1000).alias("at"))
    probes = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("h"), F.col("id") % 500)).alias("host"), (F.col("id") % 1000).alias("seen"), F.col("id").alias("n"))
    joined = timeline.asof_join(facts, probes, "host", "at", "seen", ["n"], 1000, facts_per_group=500)
    plan = joined._jdf.queryExecution().sparkPlan().toString()
    # a sort-merge join of the facts would need an exchange of its own
    assert "SortMergeJoin" not in plan and plan.count("Window") >= 1
    spread = joined.select("host", F.spark_partition_id().alias("p")).filter("host = 'hot'").groupBy("p").count().collect()
    assert sum(x["count"] for x in spread) == 20_000
    plain = timeline.asof_join(facts, probes, "host", "at", "seen", ["n"], 1000)
    assert joined.exceptAll(plain).count() == plain.exceptAll(joined).count() == 0


def test_alerts_over_batches_and_a_restart(spark, tmp_path):
    hour = "make_dt_interval(0, cast(h as int))"
    kind = "name string, h int, max_gap_hours int"
    rows = spark.createDataFrame(
        [("a", 0, 5), ("a", 1, None), ("a", 2, None), ("a", 9, None), ("b", 0, 3), ("c", 0, 100), ("c", 40, None), ("d", 30, None), ("a", 31, None)], kind
    ).select("name", F.expr(f"timestamp_ntz'2024-01-01 00:00:00' + {hour}").alias("event_time"), "max_gap_hours")
    clock = rows.limit(1).select(F.lit("clock").alias("name"), F.expr("timestamp_ntz'2024-02-01 00:00:00'").alias("event_time"), F.lit(None).cast("int").alias("max_gap_hours"))
    found = _fed(Given(spark, str(tmp_path)), rows, lambda s: alerts.absence_alarms(s, "0 seconds"), clock)
    base = 1_704_067_200_000
    got = sorted((r.name, None if r.last_run_ms is None else (r.last_run_ms - base) // 3_600_000, (r.due_ms - base) // 3_600_000) for r in found.collect())
    assert sorted(got, key=repr) == sorted([("a", 2, 7), ("a", 9, 14), ("a", 31, 36), ("b", None, 3), ("c", 40, 140)], key=repr)
