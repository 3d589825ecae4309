"""Row types of the landing tables, the lake tables and the book-keeping tables.

Unit rule: a ``timestamp_ntz`` column is naive, ``*timestamp`` columns of
``trace`` are epoch milliseconds, ``last_updated`` of the probe dumps and
``job_submit_timestamp`` are epoch seconds.
"""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal": T.DecimalType(38, 9),
    "variant": T.VariantType(),
}


def _struct(columns: str) -> T.StructType:
    """A row type from ``name type, ...`` without needing a session."""
    pairs = (item.split() for item in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


JOB_INFO = _struct(
    "job_id bigint, jdl_set boolean, trace_set boolean, status string, "
    "job_submit_timestamp bigint, last_update timestamp_ntz, site string"
)

TRACE = _struct(
    "job_id bigint, aliencpuefficiency decimal, cputime decimal, host string, "
    "maxrss bigint, cpuefficiency string, finaltimestamp bigint, masterjobid bigint, pid bigint, "
    "requestedcpus int, requestedttl bigint, runningtimestamp bigint, savingtimestamp bigint, "
    "startedtimestamp bigint, walltime int, maxvirt bigint, site string, "
    "laststatuschangetimestamp bigint"
)

MON_JDLS = _struct("job_id bigint, lpmjobtypeid string, full_jdl string")

PROBE = _struct(
    "host_id bigint, hostname string, ce_name string, addr string, "
    "last_updated bigint, test_results_json variant"
)

PART = _struct("bucket bigint, path string, records bigint")

COMMITS = _struct(
    "table string, snapshot_id bigint, sequence_number bigint, committed_at timestamp, "
    "operation string, path string, total_records bigint, cursor_kind string, cursor_value string, "
    "run_id string, table_schema string, key string, width bigint"
).add("parts", T.ArrayType(PART))

FILES = _struct("table string, path string, referenced boolean, modified_at timestamp")

RUNS = _struct("name string, phase string, event_time timestamp")

GAUGES = _struct("namespace string, job string, metric string, value double, event_time timestamp")
