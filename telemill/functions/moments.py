"""Time conversions between epoch numbers, naive and UTC timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed format: how a UTC commit time is written as text.
UTC_TEXT = "yyyy-MM-dd HH:mm:ss.SSS"
UTC_SUFFIX = " UTC"


def from_millis(ms: Column) -> Column:
    """Epoch milliseconds as a timestamp, fraction kept."""
    return F.timestamp_millis(ms)


def parse_utc(text: Column) -> Column:
    """``2026-07-12 19:40:03.327 UTC`` as a timestamp; another zone or form gives NULL."""
    bare = F.left(text, F.length(text) - F.lit(len(UTC_SUFFIX)))
    return F.when(text.endswith(UTC_SUFFIX), F.try_to_timestamp(bare, F.lit(UTC_TEXT)))


def parse_utc_strict(text: Column) -> Column:
    """As ``parse_utc``, but text that does not parse fails the job."""
    bad = F.raise_error(F.concat(F.lit("not a UTC timestamp: "), text))
    parsed = parse_utc(text)
    return F.when(text.isNull(), F.lit(None).cast("timestamp")).otherwise(
        F.coalesce(parsed, bad.cast("timestamp"))
    )
