"""Column-name normalisation: ``CPUCores`` -> ``cpu_cores``.

One rule, given twice: as a Python helper for names known when a plan is built,
and as a column expression for names that only the data knows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

PREFIX = "jdl__"

# Characters that stand for a letter, and the word-break rule.
_SYMBOLS, _LETTERS = "+-*@|", "x_xal"
_BREAK = r"(?<=[A-Za-z0-9])(?=[A-Z][a-z])|(?<=[a-z0-9])(?=[A-Z])"
_ODD = r"[^A-Za-z0-9_]+"
_LEAD = r"^(?=[0-9])"


def snake_name(name: str) -> str:
    text = name.strip().translate(str.maketrans(_SYMBOLS, _LETTERS))
    text = re.sub(_BREAK, "_", re.sub(_ODD, "_", text)).lower()
    return re.sub(_LEAD, "_", re.sub(r"__+", "_", text))


def snake_column(name: Column) -> Column:
    text = F.translate(F.trim(name), _SYMBOLS, _LETTERS)
    text = F.lower(F.regexp_replace(F.regexp_replace(text, _ODD, "_"), _BREAK, "_"))
    return F.regexp_replace(F.regexp_replace(text, "__+", "_"), _LEAD, "_")


def jdl_column(key: str) -> str:
    """Name of the flattened column for one top-level JDL key."""
    return PREFIX + snake_name(key)
