"""Repeatable landing rows for any set of job ids.

Each value is drawn from a hash of the column's name and the id, so a rerun or a replayed task
gives the same rows whatever their order, and columns do not follow each other. The times of a
job come from one life: it is submitted, waits, is set up, runs and is saved, and each stretch
has a length of its own. ``tests`` and SQL draw with the same rule: the first eight hex digits of
``md5('<name>:<id>')``, modulo the span.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.contract import EXTRA_JDL, JDL_KEYS, UNSERVED_KEYS

STATES = ("WAITING", "RUNNING", "DONE", "FAILED")
PASS_KEY, LEGACY_KEY = "LPMPassName", "LPMPASSNAME"
#: name -> seconds at most, in the order of a job's life
STRETCHES = {"queued": 14_400, "setup": 900, "run": 90_000, "save": 1_800, "settle": 120}
MAX_AGE_DAYS = 45
ODD_IN = 200


def drawn(name: str, job: Column, span: int) -> Column:
    """A number from 0 to span - 1 that depends on the name and the id alone."""
    digest = F.md5(F.concat(F.lit(f"{name}:"), job.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % span


def one_of(name: str, job: Column, values: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (drawn(name, job, len(values)) + 1).cast("int"))


def hundredths(name: str, job: Column, span: int) -> Column:
    return (drawn(name, job, span) / 100).cast("decimal(38,2)")


def life(job: Column, now: Column) -> dict[str, Column]:
    """Seconds since 1970 of each moment of a job, later ones never before earlier ones."""
    at = F.unix_seconds(now.cast("timestamp")) - drawn("age", job, MAX_AGE_DAYS * 86_400)
    moments = {"submitted": at}
    for name, longest in STRETCHES.items():
        at = at + drawn(name, job, longest)
        moments[name] = at
    return moments


def job_info_rows(ids: DataFrame, now: Column) -> DataFrame:
    """``job_info`` rows for a frame with a ``job_id`` column; ``now`` is naive."""
    job = F.col("job_id")
    moments = life(job, now)
    return ids.select(
        "job_id",
        (drawn("jdl_set", job, 50) > 0).alias("jdl_set"),
        (drawn("trace_set", job, 25) > 0).alias("trace_set"),
        one_of("status", job, STATES).alias("status"),
        moments["submitted"].alias("job_submit_timestamp"),
        F.timestamp_seconds(moments["settle"]).cast("timestamp_ntz").alias("last_update"),
        F.concat(F.lit("site-"), drawn("site", job, 40).cast("string")).alias("site"),
    )


def trace_rows(ids: DataFrame, now: Column) -> DataFrame:
    """``trace`` rows; all five timestamps are epoch milliseconds."""
    job = F.col("job_id")
    millis = {name: moment * 1000 for name, moment in life(job, now).items()}
    return ids.select(
        "job_id",
        hundredths("grid efficiency", job, 10_001).cast("decimal(38,9)").alias("aliencpuefficiency"),
        hundredths("cpu time", job, 9_000_000).cast("decimal(38,9)").alias("cputime"),
        F.concat(F.lit("node"), drawn("host", job, 300).cast("string"), F.lit(".example.org")).alias("host"),
        drawn("maxrss", job, 4_000_000).alias("maxrss"),
        hundredths("cpu efficiency", job, 10_001).cast("string").alias("cpuefficiency"),
        millis["save"].alias("finaltimestamp"),
        (job - drawn("master", job, 1_000)).alias("masterjobid"),
        (drawn("pid", job, 4_194_303) + 1).alias("pid"),
        F.pow(F.lit(2), drawn("cpus", job, 5)).cast("int").alias("requestedcpus"),
        (drawn("ttl", job, 96) * 900).alias("requestedttl"),
        millis["setup"].alias("runningtimestamp"),
        millis["run"].alias("savingtimestamp"),
        millis["queued"].alias("startedtimestamp"),
        drawn("run", job, STRETCHES["run"]).cast("int").alias("walltime"),
        drawn("maxvirt", job, 9_000_000).alias("maxvirt"),
        F.concat(F.lit("site-"), drawn("site", job, 40).cast("string")).alias("site"),
        millis["settle"].alias("laststatuschangetimestamp"),
    )


def jdl_keys() -> list[str]:
    """Every key of a generated JDL in its usual spelling: what the contract maps, and what passes through."""
    return sorted({*JDL_KEYS, *EXTRA_JDL, "TTL", "Packages", PASS_KEY} - set(UNSERVED_KEYS))


def jdl_number(job: Column) -> Column:
    return drawn("jdl", job, 1_000_000)


def jdl_text(job: Column, all_keys: bool = True, number: Column | None = None) -> Column:
    """A whole JDL. The packages are a list; every other value is text made of its key and a drawn number.

    About half of the ids spell the pass-name key in its legacy case. ``number`` is the drawn number where a column
    holds it already, as every key of a row needs it.
    """
    keys = jdl_keys() if all_keys else ["TTL", "Packages", PASS_KEY]
    pairs: list[Column] = []
    number = jdl_number(job) if number is None else number
    # no map is built: only the numbers and the spelling of one key differ between rows
    for place, key in enumerate(keys):
        if key == "Packages":
            continue
        name = F.when(drawn("spelling", job, 2) == 0, PASS_KEY).otherwise(LEGACY_KEY) if key == PASS_KEY else F.lit(key)
        pairs += [F.lit(',"' if pairs else '{"'), name, F.lit(f'":"{key[:3]} '), (number + place).cast("string"), F.lit('"')]
    packages = F.to_json(F.transform(F.sequence(F.lit(0), drawn("packages", job, 3)), lambda i: F.concat(F.lit("pkg@"), i.cast("string"))))
    return F.concat(*pairs, F.lit(',"Packages":'), packages, F.lit("}"))


def oddness(job: Column) -> Column:
    """0 for a text that is cut in its middle, 1 for one with a stray tail, else a whole text."""
    return drawn("oddness", job, ODD_IN)


def mon_jdls_rows(ids: DataFrame, all_keys: bool = True) -> DataFrame:
    """``mon_jdls`` rows; of ODD_IN ids about one is cut short and one has a stray tail."""
    job = F.col("job_id")
    # columns of their own, so that both are computed once a row
    ids = ids.select("job_id", jdl_number(job).alias("_number"))
    ids = ids.withColumn("_whole", jdl_text(job, all_keys, F.col("_number")))
    whole = F.col("_whole")
    text = (
        F.when(oddness(job) == 0, F.substring(whole, F.lit(1), F.floor(F.length(whole) / 2).cast("int")))
        .when(oddness(job) == 1, F.concat(whole, F.lit(" ;; tail")))
        .otherwise(whole)
    )
    kind = F.concat(F.lit("type "), drawn("type", job, 20).cast("string"))
    return ids.select("job_id", kind.alias("lpmjobtypeid"), text.alias("full_jdl"))
