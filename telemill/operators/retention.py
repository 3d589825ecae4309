"""Retention: find old landing keys, prove they are in the lake, delete only those.

All candidate sets come from one frozen version of the landing tables. The delete
sets are computed again from the newest version, so a job that revived in between
survives. No key list ever leaves the executors.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Decoded trace times must lie in [first, second).
PLAUSIBLE = (datetime(2020, 1, 1, tzinfo=timezone.utc), datetime(2035, 1, 1, tzinfo=timezone.utc))
TRACE_AGE = "laststatuschangetimestamp"


def millis(moment: datetime) -> int:
    """The smallest epoch millisecond at or after the moment; naive is taken as UTC."""
    aware = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    micros = (aware - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
    return -(-micros // 1000)


def naive_literal(moment: datetime) -> Column:
    """A naive timestamp literal; an aware moment is taken in UTC."""
    utc = moment.astimezone(timezone.utc) if moment.tzinfo else moment
    return F.lit(utc.replace(tzinfo=None).isoformat()).cast("timestamp_ntz")


def old_jobs(job_info: DataFrame, cutoff: datetime) -> DataFrame:
    """Distinct ids last updated strictly before the cutoff; NULL is never old."""
    return job_info.filter(F.col("last_update") < naive_literal(cutoff)).select("job_id").distinct()


def old_traces(trace: DataFrame, cutoff: datetime) -> DataFrame:
    """Distinct ids by the millisecond column, compared as an integer so that it is pushed down."""
    return trace.filter(F.col(TRACE_AGE) < millis(cutoff)).select("job_id").distinct()


def _oldest_parent(job_info: DataFrame) -> DataFrame:
    return job_info.agg(F.coalesce(F.min("job_id"), F.lit(0)).alias("floor"))


def old_jdls(mon_jdls: DataFrame, job_info: DataFrame, cutoff: datetime) -> DataFrame:
    """Distinct ids whose parent job is old, or that lost their parent to earlier retention.

    A missing parent counts only below the smallest surviving parent id: at or above
    it the parent may just not have landed yet. Ids are made distinct before the join,
    so repeated ids do not make a hot key.
    """
    ids = mon_jdls.select("job_id").distinct()
    parents = job_info.select("job_id", "last_update", F.lit(True).alias("has_parent"))
    joined = ids.join(parents, "job_id", "left")
    old = F.col("last_update") < naive_literal(cutoff)
    orphan = F.col("has_parent").isNull() & (F.col("job_id") < _oldest_parent(job_info).scalar())
    return joined.filter(old | orphan).select("job_id").distinct()


def presence(candidates: DataFrame, lake: DataFrame) -> DataFrame:
    """(job_id, verified): does the lake table hold the key? One join, ids only."""
    held = lake.select("job_id").distinct().withColumn("_held", F.lit(True))
    return candidates.join(held, "job_id", "left").select(
        "job_id", F.col("_held").isNotNull().alias("verified")
    )


def plausibility(
    trace: DataFrame, candidates: DataFrame, window: tuple[datetime, datetime] = PLAUSIBLE
) -> DataFrame:
    """One row (lo_ms, hi_ms, plausible) over the candidate rows; nothing to delete passes."""
    rows = trace.join(candidates, "job_id", "left_semi")
    lo, hi = F.min(TRACE_AGE), F.max(TRACE_AGE)
    inside = (lo >= millis(window[0])) & (hi < millis(window[1]))
    return rows.agg(
        lo.alias("lo_ms"), hi.alias("hi_ms"), F.coalesce(inside, F.lit(True)).alias("plausible")
    )


def deletable_jobs(job_info: DataFrame, verified: DataFrame, cutoff: datetime) -> DataFrame:
    """Ids to delete now: verified and still old in this version."""
    return old_jobs(job_info, cutoff).join(verified, "job_id", "left_semi")


def deletable_traces(trace: DataFrame, verified: DataFrame, cutoff: datetime) -> DataFrame:
    return old_traces(trace, cutoff).join(verified, "job_id", "left_semi")


def deletable_jdls(
    mon_jdls: DataFrame, job_info: DataFrame, verified: DataFrame, cutoff: datetime
) -> DataFrame:
    """Both branches again: the parent is still old, or still missing below the floor."""
    return old_jdls(mon_jdls.join(verified, "job_id", "left_semi"), job_info, cutoff)


def outcome(table: str, checked: DataFrame, deleted_rows: DataFrame) -> DataFrame:
    """(table, kept, deleted, unverified): rows deleted, distinct keys kept for lack of proof."""
    missing = F.count_if(~F.col("verified"))
    rows = deleted_rows.agg(F.count("*")).scalar()
    return checked.agg(missing.alias("kept"), missing.alias("unverified")).select(
        F.lit(table).alias("table"), "kept", rows.alias("deleted"), "unverified"
    )


def rollup(outcomes: DataFrame) -> DataFrame:
    """Per-table rows plus a ``total`` row, with the exit code (non-zero iff unverified)."""
    sums = [F.sum(name).alias(name) for name in ("kept", "deleted", "unverified")]
    return outcomes.rollup("table").agg(*sums).select(
        F.coalesce("table", F.lit("total")).alias("table"),
        "kept",
        "deleted",
        "unverified",
        F.when(F.col("unverified") > 0, 1).otherwise(0).alias("exit_code"),
    )


def audit_sample(checked: DataFrame, size: int = 20) -> DataFrame:
    """The smallest unverified keys, sorted: a report, not a filter."""
    return checked.filter(~F.col("verified")).select("job_id").orderBy("job_id").limit(size)
