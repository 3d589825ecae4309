"""All registered queries."""

from __future__ import annotations

from telemill.plans import queries_feed, queries_lake, queries_scan, queries_skew  # noqa: F401
from telemill.plans.registry import QUERIES

__all__ = ["QUERIES"]
