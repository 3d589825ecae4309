"""The registered queries of this subpackage, and their SQL where it can express them."""

from __future__ import annotations

import re
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemill.llm.common import table, text_or_empty

Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}


def query(run: Run) -> Run:
    QUERIES[run.__name__] = run
    return run


@query
def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    from telemill.llm.ngram_join import ngram_join

    return ngram_join(table(spark, folder, "documents"))


@query
def op2_piece_codec(spark: SparkSession, folder: str) -> DataFrame:
    from telemill.llm.piece_codec import encode_texts

    docs = table(spark, folder, "documents").select("doc_id", text_or_empty("text").alias("text"))
    encoded = encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"))
    commas = F.length("ids") - F.length(F.translate("ids", ",", ""))
    return encoded.select(
        "doc_id",
        F.when(F.col("ids") == "", 0).otherwise(commas + 1).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op3_secret_ownership(spark: SparkSession, folder: str) -> DataFrame:
    from telemill.llm.secret_scan import scan_secrets

    # a source is an owner; its documents in one language are a repository
    docs = table(spark, folder, "documents")
    found = scan_secrets(docs, F.concat_ws("/", "source", "lang"), F.col("source"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_live", "n_example", "n_shared")


@query
def op4_line_windows(spark: SparkSession, folder: str) -> DataFrame:
    from telemill.llm.line_dedup import dedup_lines

    docs = dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query
def op5_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    from telemill.llm.quality import judged

    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost")
    return judged(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", *[f"quality.{n}" for n in names])


# fixed values: the host and path rules of the pages
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


@query
def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    from telemill.llm.url_filter import filter_urls

    pages = table(spark, folder, "pages").select("page_id", "url")
    return filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query
def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    from telemill.llm.token_files import read_tokens, with_checksum, write_tokens
    from telemill.session import scratch

    target = scratch(spark, "tokens")
    write_tokens(table(spark, folder, "documents"), target, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return with_checksum(read_tokens(spark, target)).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    from telemill.llm.token_counts import count_tokens

    # the public piece vocabulary, with its scores, read as a unigram vocabulary
    return count_tokens(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op9_benchmark_edits(spark: SparkSession, folder: str) -> DataFrame:
    from telemill.llm.decontaminate import find_items

    return find_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from telemill.llm.substring_dedup import dedup_substrings

    out = dedup_substrings(table(spark, folder, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op11_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    from telemill.llm.bpe_codec import encode_texts

    docs = table(spark, folder, "documents").select("doc_id", "text")
    encoded = encode_texts(docs, public_tokenizers.path("word_bpe_49k.json"))
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    from telemill.llm.conversation_repair import Repair, damage

    return Repair(damage(table(spark, folder, "conversations"))).verdicts()


@query
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    from telemill.llm.spelling_variants import count_words, variants

    return variants(count_words(table(spark, folder, "documents"), drop_every=97))


SQL["op4_line_windows"] = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS n
  FROM documents
), shown AS (
  SELECT doc_id, n, raw, trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line,
         row_number() OVER (PARTITION BY doc_id ORDER BY n) AS k
  FROM lines WHERE trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''
), windows AS (
  SELECT doc_id, k, line AS a, lead(line, 1) OVER w AS b, lead(line, 2) OVER w AS c
  FROM shown WINDOW w AS (PARTITION BY doc_id ORDER BY k)
), later AS (
  SELECT doc_id, k FROM windows WHERE c IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, k) > 1
), gone AS (
  SELECT DISTINCT s.doc_id, s.n FROM later l JOIN shown s ON s.doc_id = l.doc_id AND s.k BETWEEN l.k AND l.k + 2
), kept AS (
  SELECT l.doc_id, string_agg(l.raw, chr(10) ORDER BY l.n) AS text
  FROM lines l ANTI JOIN gone g ON g.doc_id = l.doc_id AND g.n = l.n GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(r.n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id) r USING (doc_id)
"""

SQL["op10_substring_dedup"] = r"""
WITH docs AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 11, 1))) AS i FROM docs)
), gone AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY gram) AS first FROM windows) WHERE doc_id > first
), covered AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS n FROM gone
), words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS n FROM docs
), kept AS (
  SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.n) AS text
  FROM words w ANTI JOIN covered c ON c.doc_id = w.doc_id AND c.n = w.n GROUP BY w.doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(r.n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n_removed FROM covered GROUP BY doc_id) r USING (doc_id)
"""

SQL["op5_line_quality"] = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS l,
         list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w
  FROM documents
), grams AS (
  SELECT doc_id, i, (w[i], w[i + 1], w[i + 2]) AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM texts)
), again AS (
  SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), repeats AS (
  SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id
), rules AS (
  SELECT *, regexp_replace(t, '[ \t\n\x0B\f\r]', '', 'g') AS bare, list_filter(l, lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS shown,
    list_filter(l, lambda x: NOT (regexp_matches(x, '[^ \t\n\x0B\f\r]') AND (
      regexp_matches(x, '@NAVIGATION@') OR @PUNCTUATION@ OR @BOILERPLATE@
      OR regexp_matches(x, '[!?]{2}[^\p{L} \t\x0B\f\r]*([ \t\x0B\f\r]|$)')
      OR (len(regexp_extract_all(x, '\p{L}')) >= 20
          AND 100 * len(regexp_extract_all(x, '\p{Lu}')) > 70 * len(regexp_extract_all(x, '\p{L}')))
      OR (len(list_filter(words_of(x), lambda w: regexp_matches(w, '[#$%&*]{3}'))) >= 3
          AND 2 * len(list_filter(words_of(x), lambda w: regexp_matches(w, '[#$%&*]{3}'))) >= len(words_of(x)))
      OR (len(regexp_extract_all(x, '[|»•·]')) >= 4 AND NOT regexp_matches(x, '@CODE@')
          AND 2 * len(words_of(regexp_replace(x, '[|»•·]', ' ', 'g'))) <= 3 * (len(regexp_extract_all(x, '[|»•·]')) + 1)
          AND NOT regexp_matches(x, '^[ \t\x0B\f\r]*\|(.*\|)?[ \t\x0B\f\r]*$'))
    ))) AS clean
  FROM texts
), counted AS (
  SELECT r.doc_id, len(w)::BIGINT AS n_words, length(bare)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(shown) - len(list_distinct(shown)))::BIGINT AS n_dup_lines, coalesce(p.n, 0)::BIGINT AS n_repeat_words,
         (length(bare) - length(regexp_replace(array_to_string(clean, ''), '[ \t\n\x0B\f\r]', '', 'g')))::BIGINT AS lost
  FROM rules r LEFT JOIN repeats p USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost <= word_chars * 0.5 AS kept
FROM counted
"""


def _with_rules(sql: str) -> str:
    """The rules' lists and patterns put into the SQL, whose expressions need no possessive repeats: they take linear time anyway."""
    from telemill.llm.quality import LineRules

    rules = LineRules()
    plain = lambda pattern: pattern.replace("*+", "*").replace("++", "+").replace("'", "''")
    punctuation = " OR ".join(f"regexp_matches(x, '{plain(pattern)}')" for pattern in rules.punctuation)
    boilerplate = " OR ".join(f"contains(lower(x), '{phrase}')" for phrase in rules.boilerplate)
    sql = sql.replace("@NAVIGATION@", plain(rules.navigation)).replace("@PUNCTUATION@", punctuation)
    sql = re.sub(r"words_of\(((?:[^()]|\([^()]*\))*)\)", r"regexp_extract_all(\1, '[^ \\t\\x0B\\f\\r]+')", sql)
    return sql.replace("@BOILERPLATE@", boilerplate).replace("@CODE@", plain(rules.code))


SQL["op5_line_quality"] = _with_rules(SQL["op5_line_quality"])
