from __future__ import annotations

import pytest


@pytest.fixture
def frame(spark):
    """A documents table from (doc_id, text) pairs, with the other columns of the given tables."""

    def build(rows):
        full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint")

    return build
