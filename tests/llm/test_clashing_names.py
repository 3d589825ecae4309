"""Extra columns that are named like what the operators make or use inside."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from telemill.llm import decontaminate, line_dedup, ngram_join, piece_codec, quality, substring_dedup, token_counts, url_filter

NAMES = ["quality", "n_removed", "ids", "decoded", "starts", "at", "anchor", "window", "first", "rep", "same", "bands", "windows", "distance"]


def test_clashing_columns_of_documents(spark, frame):
    prose = "\n".join(" ".join(f"word{chr(97 + i)}{chr(97 + k)}" for k in range(10)) + "." for i in range(8))
    docs = frame([(1, prose), (2, prose)]).withColumns({name: F.lit("x") for name in NAMES})
    model = public_tokenizers.path("piece_bpe_32k.model")
    assert quality.clean_documents(docs).columns == docs.columns and quality.clean_documents(docs).count() == 2
    assert set(quality.judged(docs).columns) == set(docs.columns)
    lines = line_dedup.dedup_lines(docs)
    assert sorted(lines.columns) == sorted(docs.columns) and {r.n_removed for r in lines.collect()} == {0, 8}
    encoded = piece_codec.encode_texts(docs, model)
    assert sorted(encoded.columns) == sorted(set(docs.columns) - {"text"}) and encoded.first().ids != "x"
    bench = spark.createDataFrame([(1, prose[:60], "x")], "item_id bigint, text string, distance string")
    assert decontaminate.clean_documents(docs, bench).count() == 0
    assert decontaminate.find_items(docs, bench).count() == 2
    assert ngram_join.ngram_join(docs).count() == substring_dedup.dedup_substrings(docs).count() == token_counts.count_tokens(docs, model).count() == 2


def test_clashing_columns_of_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x", "y")], "page_id bigint, url string, host string")
    pages = pages.withColumns({name: F.lit("x") for name in ("path", "rule", "score", "verdict", "shape", "fold", "ruled", "gram")})
    row = url_filter.filter_urls(pages, [("allow", "com", "/")]).first()
    assert (row.host, row.path, row.rule, row.verdict, row.shape) == ("a.com", "/x", "com/", "allow", "x")
