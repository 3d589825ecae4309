"""The registry, and a quick comparison of cheap queries with their SQL.

``python tests/compare.py <folder>`` compares all of them.
"""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
QUICK = """
scan_naive_cursor scan_millis_cursor dump_listing link_resolution files_read_once jdl_flatten parse_flags
prose_decode utc_text old_traces one_row_per_key expired_versions freshness recheck_at_delete presence_check
reconcile probe_at_start counter_increase failures_last_week gauge_breaches absent_schedules
""".split()

needs_data = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def test_every_query_has_sql_of_the_same_name():
    own = {name for name in entry.queries() if name in entry.QUERIES}
    assert own == {name for name in entry.oracle_sql() if name in entry.QUERIES}
    assert len(own) >= 90


@needs_data
@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, name):
    assert differences(entry.queries()[name](spark, FOLDER), connect(FOLDER), entry.oracle_sql()[name]) is None


@needs_data
def test_flagship(spark):
    got = entry.entry(spark)
    assert got.columns == ["LPMPassName", "jobs", "parsed", "cores"]
    assert sum(r.jobs for r in got.collect()) == spark.read.parquet(f"{FOLDER}/events.parquet").count()
