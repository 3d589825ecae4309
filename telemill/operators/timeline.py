"""Ordered per-key work that survives hot keys: time buckets with carried values.

A key may hold a large share of all rows, so no window is partitioned by the key
alone. Rows are split into (key, time bucket) groups; what a group needs from
earlier buckets is computed from pre-aggregated per-bucket values and added to the
group as one seed row. Only that small per-bucket frame is ordered by key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemill.session import stored


#: groups of the as-of join that may be split, and so be broadcast
HOT_GROUPS = 10_000


def carried_seeds(per_bucket: DataFrame, key: str, value: str) -> DataFrame:
    """For each (key, bucket): the last non-null ``value`` of the earlier buckets."""
    earlier = (
        Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = F.last(value, ignorenulls=True).over(earlier)
    return per_bucket.withColumn(value, carried).filter(F.col(value).isNotNull())


def _spread_hash(df: DataFrame) -> Column:
    """A repeatable hash of the row, for salting; the same on every task attempt."""
    plain = [
        field.name
        for field in df.schema
        if not isinstance(field.dataType, (T.MapType, T.VariantType))
    ]
    return F.xxhash64(*plain)


def asof_join(
    facts: DataFrame,
    probes: DataFrame,
    key: str,
    fact_time: str,
    probe_time: str,
    probe_columns: Sequence[str],
    bucket: int,
    facts_per_group: int = 1_000_000,
) -> DataFrame:
    """Each fact with the latest probe of its key strictly before it; unmatched facts stay.

    ``fact_time`` and ``probe_time`` are integers of the same unit, ``bucket`` is a
    bucket's length in that unit. Probes at equal times are ordered by their columns,
    so the result is deterministic. Adds ``probe_<time>`` and the probe columns.

    Skew: probes are folded to one per (key, time), so a group holds at most
    ``bucket`` of them; a group with more than ``facts_per_group`` facts is split by a
    hash of the fact, and only its few probes are repeated. Which groups are that large is
    known before any fact is shuffled: they are counted by a combined aggregate into a
    stored table, and the large ones, of which there are at most ``HOT_GROUPS``, are broadcast.
    The facts are shuffled once, salted.
    """
    probe = F.struct(F.col(probe_time).alias("_t"), *probe_columns)
    folded = (
        probes.filter(F.col(key).isNotNull() & F.col(probe_time).isNotNull())
        .groupBy(key, F.col(probe_time).alias("_at"))
        .agg(F.max(probe).alias("_probe"))
        .withColumn("_bucket", F.expr(f"_at div {bucket}L"))
    )
    probe_type = folded.schema["_probe"].dataType
    placed = facts.withColumns(
        {
            "_bucket": F.expr(f"`{fact_time}` div {bucket}L"),
            "_at": F.col(fact_time),
            "_is_probe": F.lit(0),
            "_hash": _spread_hash(facts),
        }
    )
    marks = placed.select(
        key, "_bucket", F.lit(None).cast(probe_type).alias("_probe"), F.lit(1).alias("_n")
    ).unionByName(folded.select(key, "_bucket", "_probe", F.lit(0).alias("_n")))
    per_bucket = stored(
        marks.groupBy(key, "_bucket").agg(F.max("_probe").alias("_probe"), F.sum("_n").alias("_n")), "asof-groups"
    )
    # no more than HOT_GROUPS groups can hold more than one part in HOT_GROUPS of all facts
    total = per_bucket.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    most = max(facts_per_group, -(-total // HOT_GROUPS))
    salts = F.ceil(F.col("_n") / most)
    hot = F.broadcast(per_bucket.filter(F.col("_n") > most).select(key, "_bucket", salts.alias("_salts")))
    seeds = carried_seeds(per_bucket.drop("_n"), key, "_probe").withColumn(
        "_at", F.lit(None).cast("bigint")
    )
    one = F.coalesce("_salts", F.lit(1))
    # facts without key or time match nothing: any group does
    free = F.col(key).isNull() | F.col("_at").isNull()
    salted_facts = placed.join(hot, [key, "_bucket"], "left").withColumn(
        "_salt", F.pmod("_hash", F.when(free, 4096).otherwise(one))
    )
    repeated = (
        folded.unionByName(seeds.select(folded.columns))
        .withColumn("_is_probe", F.lit(1))
        .join(hot, [key, "_bucket"], "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), one - 1)))
    )
    rows = salted_facts.drop("_hash", "_salts").unionByName(
        repeated.drop("_salts"), allowMissingColumns=True
    )
    # seeds (no time) first; at equal times facts come before probes: strictly before
    upto = (
        Window.partitionBy(key, "_bucket", "_salt")
        .orderBy(F.col("_at").asc_nulls_first(), "_is_probe")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = rows.withColumn("_found", F.last("_probe", ignorenulls=True).over(upto))
    return found.filter("_is_probe = 0").select(
        *facts.columns,
        F.col("_found._t").alias(f"probe_{probe_time}"),
        *[F.col(f"_found.{name}").alias(name) for name in probe_columns],
    )


def counter_increase(
    samples: DataFrame, series: str, at: str, value: str, bucket: int
) -> DataFrame:
    """Increase since the previous sample of each series; a drop is a reset from zero.

    ``at`` is epoch seconds. The first sample of a series has no increase (NULL).
    """
    work = samples.withColumn("_bucket", F.expr(f"`{at}` div {bucket}L"))
    newest = F.max(F.struct(at, value)).alias("_last")
    seeds = carried_seeds(work.groupBy(series, "_bucket").agg(newest), series, "_last").select(
        series, "_bucket", F.lit(None).cast("bigint").alias(at), F.col(f"_last.{value}").alias(value)
    )
    rows = work.withColumn("_seed", F.lit(False)).unionByName(
        seeds.withColumn("_seed", F.lit(True)), allowMissingColumns=True
    )
    order = Window.partitionBy(series, "_bucket").orderBy(
        F.col("_seed").desc(), F.col(at), F.col(value)
    )
    before = F.lag(value).over(order)
    delta = F.when(F.col(value) >= before, F.col(value) - before).otherwise(F.col(value))
    with_delta = rows.withColumn("increase", F.when(before.isNotNull(), delta))
    return with_delta.filter(~F.col("_seed")).select(*samples.columns, "increase")


def _increases(batches: Iterator[pa.RecordBatch], at: str, series: str, value: str) -> Iterator[pa.RecordBatch]:
    """Sorted rows of one task with their increase; the first row of each series is marked, for its predecessor is not here."""
    part = TaskContext.get().partitionId()
    last_series: object = _NOTHING
    last_value = None
    for batch in batches:
        keys, values = batch.column(series).to_pylist(), batch.column(value).to_pylist()
        increase, begins = [], []
        for name, now in zip(keys, values):
            begin = name != last_series
            step = None if begin or last_value is None or now is None else now - last_value if now >= last_value else now
            increase.append(step)
            begins.append(begin)
            last_series, last_value = name, now
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(increase, batch.schema.field(value).type), pa.array(begins), pa.array([part] * len(batch), pa.int64())],
            [*batch.schema.names, "increase", "_begins", "_part"],
        )


_NOTHING = object()


def counter_increase_by_ranges(samples: DataFrame, series: str, at: str, value: str) -> DataFrame:
    """``counter_increase`` for series of any size: a series is cut wherever the rows are, not by day.

    Rows are sorted over ranges of (series, time), so one series spreads over all tasks. A task sums up what it holds
    of a series as (first, last); the last value before a task's first sample comes from these sums alone, of
    which there is one for each task and series, and only the marked first samples are joined with them.
    """
    order = [series, at, value]
    ranged = samples.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = samples.withColumns({"increase": F.col(value), "_begins": F.lit(True), "_part": F.lit(0).cast("bigint")}).schema
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    rows = stored(ranged.mapInArrow(partial(_increases, at=at, series=series, value=value), schema), "counter-ranges")
    ends = rows.groupBy(series, "_part").agg(F.max_by(value, F.struct(at, value)).alias("_last"))
    earlier = Window.partitionBy(series).orderBy("_part")
    ends = ends.select(F.col(series).alias("_series"), F.col("_part").alias("_of"), F.lag("_last").over(earlier).alias("_before"))
    same = F.col(series).eqNullSafe(F.col("_series")) & (F.col("_part") == F.col("_of"))
    begun = rows.filter("_begins").join(ends, same, "left")
    step = F.when(F.col(value) >= F.col("_before"), F.col(value) - F.col("_before")).otherwise(F.col(value))
    begun = begun.withColumn("increase", F.when(F.col("_before").isNotNull(), step))
    columns = [*samples.columns, "increase"]
    return rows.filter("not _begins").select(columns).unionByName(begun.select(columns))


def breach_runs(
    steps: DataFrame, keys: Sequence[str], at: str, breached: Column, step: int, hold: int
) -> DataFrame:
    """Unbroken runs of breached steps that lasted at least ``hold`` seconds.

    ``steps`` holds one row per key and step (already aggregated), ``at`` in epoch
    seconds. A missing step ends a run.
    """
    hit = steps.filter(breached)
    order = Window.partitionBy(*keys).orderBy(at)
    island = F.col(at) - F.row_number().over(order) * F.lit(step)
    runs = hit.withColumn("_island", island).groupBy(*keys, "_island").agg(
        F.min(at).alias("start_s"), F.max(at).alias("end_s"), F.count("*").alias("steps")
    )
    return runs.filter(F.col("end_s") - F.col("start_s") >= hold).drop("_island")
