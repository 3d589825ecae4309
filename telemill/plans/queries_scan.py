"""Queries on sources, scans, decoding and projections."""

from __future__ import annotations

import lzma
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemill import contract
from telemill.functions import moments
from telemill.functions.jdl import decode_jdl, flatten_jdl, json_object
from telemill.operators import quality, retention
from telemill.operators.drift import contract_rows, drift, drift_verdict, schema_rows
from telemill.plans import jobs
from telemill.plans.domain import PROSE_SQL, SQL, Given, ctes, decoded_sql
from telemill.plans.registry import query
from telemill.session import spread
from telemill.sources import cursors, dumps, generator

CHUNK = 20_000
SHOWN_KEYS = ["TTL", "CPUCores", "Price", "JobTag", "Packages", "LPMMetaData", "PWG", "LPMPassName", "Extra"]

# ---- incremental scans ------------------------------------------------------------


@query(f"SELECT * FROM ({SQL['job_info']}) WHERE last_update >= TIMESTAMP '1998-06-01'")
def scan_naive_cursor(given: Given) -> DataFrame:
    return cursors.since(given.job_info, "last_update", "naive", "1998-06-01T00:00:00")


@query(f"SELECT * FROM ({SQL['trace']}) WHERE laststatuschangetimestamp >= 904608000000")
def scan_millis_cursor(given: Given) -> DataFrame:
    return cursors.since(given.trace, "laststatuschangetimestamp", "integer", "904608000000")


@query(f"SELECT * FROM ({SQL['mon_jdls']}) WHERE job_id >= 2500")
def scan_key_cursor(given: Given) -> DataFrame:
    return cursors.since(given.mon_jdls, "job_id", "integer", "2500")


@query(
    f"""SELECT count(*) FILTER (last_update >= TIMESTAMP '1998-06-01') AS selected,
    count(*) FILTER (last_update < TIMESTAMP '1998-06-01') AS passed,
    count(*) FILTER (last_update IS NULL) AS null_cursor
    FROM (SELECT CASE WHEN job_id % 9 <> 0 THEN last_update END AS last_update FROM ({SQL['job_info']}))"""
)
def cursor_reach(given: Given) -> DataFrame:
    holes = given.job_info.withColumn(
        "last_update", F.when(F.col("job_id") % 9 != 0, F.col("last_update"))
    )
    return cursors.cursor_report(holes, "last_update", "naive", "1998-06-01T00:00:00")


@query(
    f"""SELECT o_orderkey // {CHUNK} AS chunk, count(*) AS rows, min(o_orderkey) AS lo, max(o_orderkey) AS hi
    FROM orders GROUP BY 1"""
)
def extraction_chunks(given: Given) -> DataFrame:
    chunk = F.expr(f"job_id div {CHUNK}L")
    return given.job_info.groupBy(chunk.alias("chunk")).agg(
        F.count("*").alias("rows"), F.min("job_id").alias("lo"), F.max("job_id").alias("hi")
    )


# ---- dump files ---------------------------------------------------------------------


def listing_pages(given: Given) -> DataFrame:
    """The given pages, each with one dump link and one link that must not match."""
    page = F.col("page_id")
    prefix = (
        F.when(page % 3 == 0, "https://dumps.example.org/d/").when(page % 3 == 1, "/d/").otherwise("")
    )
    link = F.concat(
        F.lit('<a href="'), prefix, F.lit("site-sonar-"), (page * 977 + 1_700_000_000).cast("string"),
        F.lit('.out.xz">dump</a><a href="/up/">Up To</a>'),
    )
    return given.pages.select(F.col("url").alias("base_url"), F.concat("html", link).alias("html"))


_ORIGIN = "regexp_extract(base_url, '^[^:/?#]+://[^/?#]*')"


def _link_sql(href: str) -> str:
    return f"""CASE WHEN starts_with({href}, 'http://') OR starts_with({href}, 'https://') THEN {href}
    WHEN starts_with({href}, '/') THEN {_ORIGIN} || {href} ELSE rtrim(base_url, '/') || '/' || {href} END"""


_LISTING_SQL = f"""
SELECT regexp_extract(href, 'site-sonar-(\\d+)\\.out\\.xz$', 1)::BIGINT AS epoch, {_link_sql('href')} AS url
FROM (
  SELECT url AS base_url, unnest(regexp_extract_all(
    html || '<a href="' || CASE page_id % 3 WHEN 0 THEN 'https://dumps.example.org/d/' WHEN 1 THEN '/d/' ELSE '' END
    || 'site-sonar-' || (page_id * 977 + 1700000000) || '.out.xz">dump</a><a href="/up/">Up To</a>',
    'href="([^"]*?site-sonar-(\\d+)\\.out\\.xz)"', 1)) AS href
  FROM pages
)"""


@query(_LISTING_SQL)
def dump_listing(given: Given) -> DataFrame:
    return dumps.list_dumps(listing_pages(given))


@query(
    f"""SELECT base_url, pos::INTEGER AS pos, href, {_link_sql('href')} AS link FROM (
      SELECT url AS base_url, unnest(found) AS href, unnest(range(len(found))) AS pos
      FROM (SELECT url, regexp_extract_all(html, 'href="([^"]*)"', 1) AS found FROM pages))"""
)
def link_resolution(given: Given) -> DataFrame:
    return dumps.links(given.pages, "url", "html", r'href="([^"]*)"')


@query(f"SELECT * FROM ({_LISTING_SQL}) WHERE epoch > 1700100000")
def newer_dumps(given: Given) -> DataFrame:
    return dumps.newer_than(dumps.list_dumps(listing_pages(given)), 1_700_100_000)


@query(f"SELECT * FROM ({_LISTING_SQL}) WHERE epoch > 1700100000 ORDER BY epoch DESC, url LIMIT 25")
def newest_dumps(given: Given) -> DataFrame:
    fresh = dumps.newer_than(dumps.list_dumps(listing_pages(given)), 1_700_100_000)
    return dumps.take_files(fresh, 25, order="newest")


@query(f"SELECT greatest(1700100000, max(epoch)) AS mark FROM ({_LISTING_SQL}) WHERE epoch > 1700100000")
def high_water_mark(given: Given) -> DataFrame:
    fresh = dumps.newer_than(dumps.list_dumps(listing_pages(given)), 1_700_100_000)
    return dumps.next_mark(fresh, 1_700_100_000)


@query(
    f"""WITH files AS ({_LISTING_SQL}), first AS (SELECT * FROM files ORDER BY epoch, url LIMIT 40)
    SELECT epoch, url, CASE WHEN epoch <= (SELECT max(epoch) FROM first) THEN 1 ELSE 2 END AS run FROM files"""
)
def files_read_once(given: Given) -> DataFrame:
    """Two runs, the first with a limit: every file is read exactly once."""
    files = dumps.list_dumps(listing_pages(given))
    first = dumps.take_files(files, 40)
    second = files.filter(F.col("epoch") > dumps.next_mark(first, 0).scalar())
    return first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2)))


PER_FILE = 500


def _compress(batch: pd.DataFrame) -> pd.DataFrame:
    text = "\n".join(batch.sort_values("event_id")["line"])
    return pd.DataFrame({"path": [batch["path"].iloc[0]], "content": [lzma.compress(text.encode())]})


def dump_contents(given: Given) -> DataFrame:
    """The events as compressed dump files of 500 events, with malformed and blank lines."""
    event = F.col("event_id")
    doc = F.to_json(
        F.struct(
            F.col("user_id").alias("host_id"),
            F.concat(F.lit("wn"), F.col("user_id").cast("string")).alias("hostname"),
            F.col("event_type").alias("ce_name"),
            F.lit("192.0.2.1").alias("addr"),
            F.unix_seconds(F.col("ts").cast("timestamp")).alias("last_updated"),
            F.struct(F.struct(F.col("event_type").alias("NAME"), (event % 7).alias("EXITCODE")).alias("os"),
                F.array(F.col("event_type"), (event % 7).cast("string")).alias("devices"),
            ).alias("test_results_json"),
        )
    )
    line = (
        F.when(event % 50 == 0, F.concat(F.lit("<html>502 bad gateway</html>\n"), doc))
        .when(event % 50 == 1, F.concat(F.lit('{"host_id": 12, "addr":\n\n'), doc))
        .otherwise(doc)
    )
    path = F.concat(
        F.lit("site-sonar-"), (F.expr(f"event_id div {PER_FILE}") + 1_700_000_000).cast("string"), F.lit(".out.xz")
    )
    lines = given.events.select("event_id", path.alias("path"), line.alias("line"))
    return lines.groupBy("path").applyInPandas(_compress, "path string, content binary")


@query(
    """SELECT user_id AS host_id, 'wn' || user_id AS hostname, event_type AS ce_name, '192.0.2.1' AS addr,
    floor(epoch(ts))::BIGINT AS last_updated, event_type AS os_name, event_id % 7 AS os_code FROM events"""
)
def dump_reader(given: Given) -> DataFrame:
    rows = dumps.probe_rows(dumps.dump_lines(dump_contents(given)))
    return rows.select(
        "host_id", "hostname", "ce_name", "addr", "last_updated",
        F.variant_get("test_results_json", "$.os.NAME", "string").alias("os_name"),
        F.variant_get("test_results_json", "$.os.EXITCODE", "bigint").alias("os_code"),
    )


@query(
    f"""SELECT 'site-sonar-' || (event_id // {PER_FILE} + 1700000000) || '.out.xz' AS path,
    (count(*) + count(*) FILTER (event_id % 50 < 2))::BIGINT AS lines, count(*) AS good,
    count(*) FILTER (event_id % 50 < 2) AS skipped FROM events GROUP BY 1"""
)
def dump_line_report(given: Given) -> DataFrame:
    return dumps.line_report(dumps.dump_lines(dump_contents(given)))


@query(
    """SELECT 'wn' || user_id AS hostname, floor(epoch(ts))::BIGINT AS last_updated, idx::INTEGER AS idx,
    CASE idx WHEN 0 THEN event_type ELSE (event_id % 7)::VARCHAR END AS value
    FROM events, (VALUES (0), (1)) v(idx)"""
)
def probe_children(given: Given) -> DataFrame:
    """A list inside the drifting test results as a child table."""
    rows = dumps.probe_rows(dumps.dump_lines(dump_contents(given)))
    return dumps.test_children(rows, "$.devices")


# ---- schema and file metadata ---------------------------------------------------------

_TABLES = ("orders", "lineitem", "events", "pages", "documents")


@query(
    "SELECT table_name AS \"table\", column_name AS \"column\", CASE data_type WHEN 'VARCHAR' THEN 'string' "
    "WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS type "
    f"FROM information_schema.columns WHERE table_name IN {_TABLES}"
)
def schema_columns(given: Given) -> DataFrame:
    frames = [schema_rows(getattr(given, name), name) for name in _TABLES]
    rows = frames[0]
    for frame in frames[1:]:
        rows = rows.unionByName(frame)
    return rows.select("table", "column", "type")


@query(
    " UNION ALL ".join(f"SELECT '{t}' AS \"table\", 1::BIGINT AS files, count(*) AS rows FROM {t}" for t in _TABLES)
)
def file_inventory(given: Given) -> DataFrame:
    """Files and rows per table; reads file footers only."""
    rows = None
    for name in _TABLES:
        per_file = getattr(given, name).groupBy("_metadata.file_path").count()
        counted = per_file.agg(F.count("*").alias("files"), F.sum("count").alias("rows")).select(
            F.lit(name).alias("table"), "files", "rows"
        )
        rows = counted if rows is None else rows.unionByName(counted)
    return rows


@query(
    """SELECT 'landing' AS side, count(*) AS rows, count(DISTINCT o_orderkey) AS keys FROM orders
    UNION ALL SELECT 'lake', count(*), count(DISTINCT o_orderkey) FROM orders WHERE o_orderkey % 7 <> 0"""
)
def both_catalogs(given: Given) -> DataFrame:
    counts = quality.table_counts({"landing": given.job_info, "lake": given.lake_keys})
    return counts.select(F.col("table").alias("side"), "rows", "keys")


# ---- JDL decoding ---------------------------------------------------------------------

_DECODED = "WITH " + decoded_sql(SQL["mon_jdls"])


def _value(key: str) -> str:
    return f"max(v) FILTER (k = '{key}')"


_WIDE_SQL = _DECODED + (
    "SELECT o.job_id, o.lpmjobtypeid, o.doc IS NOT NULL AS jdl_parse_ok, "
    "CASE WHEN o.doc IS NULL THEN o.full_jdl END AS full_jdl_raw, "
    + ", ".join(f"w.\"{key}\" AS {name}" for key, name in [
        ("TTL", "jdl__ttl"), ("CPUCores", "jdl__cpu_cores"), ("Price", "jdl__price"),
        ("JobTag", "jdl__job_tag"), ("Packages", "jdl__packages"), ("MetaData", "jdl__meta_data"),
        ("PWG", "jdl__pwg"), ("LPMPassName", "jdl__lpm_pass_name"), ("Extra", "jdl__extra"),
    ])
    + " FROM obj o LEFT JOIN (SELECT job_id, "
    + ", ".join(
        f"{_value(key)} AS \"{key}\""
        for key in ("TTL", "CPUCores", "Price", "JobTag", "Packages", "MetaData", "PWG", "LPMPassName", "Extra")
    )
    + " FROM pairs GROUP BY job_id) w ON w.job_id = o.job_id"
)
_WIDE_KEYS = ["TTL", "CPUCores", "Price", "JobTag", "Packages", "MetaData", "PWG", "LPMPassName", "Extra"]


@query(_WIDE_SQL)
def jdl_flatten(given: Given) -> DataFrame:
    """Decode, merge, canonicalise and flatten: one row out per row in."""
    return flatten_jdl(decode_jdl(given.mon_jdls), _WIDE_KEYS)


@query(
    f"""SELECT job_id, coalesce(CASE WHEN json_valid(full_jdl) THEN json_type(full_jdl) = 'OBJECT' END, false)
    AS is_object FROM ({SQL['mon_jdls']})"""
)
def strict_object(given: Given) -> DataFrame:
    parsed = json_object(given.mon_jdls, "full_jdl", "doc")
    return parsed.select("job_id", F.col("doc").isNotNull().alias("is_object"))


@query(
    _DECODED
    + """SELECT p.job_id, max(v) FILTER (k = 'JobTag') AS job_tag, max(v) FILTER (k = 'Packages') AS packages
    FROM pairs p JOIN direct d ON d.job_id = p.job_id WHERE NOT d.plain GROUP BY p.job_id"""
)
def escaped_fallback(given: Given) -> DataFrame:
    """Only texts that are no JSON object themselves but decode as a string-literal body."""
    direct = json_object(given.mon_jdls, "full_jdl", "doc").filter("doc IS NULL").drop("doc")
    found = decode_jdl(direct).filter("jdl_parse_ok")
    return found.select("job_id", F.col("jdl")["JobTag"].alias("job_tag"), F.col("jdl")["Packages"].alias("packages"))


@query(
    _DECODED
    + """SELECT job_id, max(v) FILTER (k = 'LPMPassName') AS pass_name,
    count(*) FILTER (lower(k) = 'lpmpassname') AS spellings FROM pairs GROUP BY job_id"""
)
def case_variant_merge(given: Given) -> DataFrame:
    decoded = decode_jdl(given.mon_jdls).filter("jdl_parse_ok")
    same = F.filter(F.map_keys("jdl"), lambda k: F.lower(k) == "lpmpassname")
    return decoded.select(
        "job_id",
        F.try_element_at(F.col("jdl"), F.lit("LPMPassName")).alias("pass_name"),
        F.size(same).cast("bigint").alias("spellings"),
    )


@query(_DECODED + "SELECT job_id, k AS key, v AS value FROM pairs")
def canonical_values(given: Given) -> DataFrame:
    return decode_jdl(given.mon_jdls).select("job_id", F.explode("jdl").alias("key", "value"))


@query(
    _DECODED
    + """SELECT job_id, doc IS NOT NULL AS jdl_parse_ok,
    CASE WHEN doc IS NULL THEN full_jdl END AS full_jdl_raw FROM obj"""
)
def parse_flags(given: Given) -> DataFrame:
    return decode_jdl(given.mon_jdls).select("job_id", "jdl_parse_ok", "full_jdl_raw")


@query(
    _DECODED
    + """SELECT job_id, unnest(range(json_array_length(v)::BIGINT))::INTEGER AS idx,
    unnest(json_extract_string(v, '$[*]')) AS value FROM pairs WHERE k = 'Packages'"""
)
def list_children(given: Given) -> DataFrame:
    """A list value as a child table: parent key, position, item."""
    decoded = decode_jdl(given.mon_jdls).filter("jdl_parse_ok")
    items = F.from_json(F.try_element_at(F.col("jdl"), F.lit("Packages")), "array<string>")
    return decoded.select("job_id", F.posexplode(items).alias("idx", "value"))


@query(
    _DECODED
    + """SELECT count(*) AS rows, count(doc) AS parsed, count(full_jdl) FILTER (doc IS NULL) AS kept_raw,
    count(*) FILTER (full_jdl IS NULL) AS null_input FROM obj"""
)
def parse_report(given: Given) -> DataFrame:
    return quality.parse_report(decode_jdl(given.mon_jdls))


@query(
    """SELECT doc_id AS job_id, true AS jdl_parse_ok, md5(text) AS text_md5, length(text)::BIGINT AS text_chars,
    source AS tag, '["' || lang || '"]' AS input_data FROM documents"""
)
def prose_decode(given: Given) -> DataFrame:
    """Whole documents as JDL values, half of them escaped: the text comes back unchanged."""
    decoded = decode_jdl(given.prose_jdls)
    text = F.col("jdl")["Arguments"]
    return decoded.select(
        "job_id", "jdl_parse_ok", F.md5(text).alias("text_md5"), F.length(text).cast("bigint").alias("text_chars"),
        F.col("jdl")["JobTag"].alias("tag"), F.col("jdl")["InputData"].alias("input_data"),
    )


_SNAKE_SQL = (
    "'jdl__' || lower(regexp_replace(regexp_replace(k, '([A-Za-z0-9])([A-Z][a-z])', '\\1_\\2', 'g'), "
    "'([a-z0-9])([A-Z])', '\\1_\\2', 'g'))"
)


@query(_DECODED + f'SELECT k AS key, {_SNAKE_SQL} AS "column", count(*) AS rows, count(v) AS filled FROM pairs GROUP BY k')
def key_census(given: Given) -> DataFrame:
    return quality.key_census(decode_jdl(given.mon_jdls))


@query(
    f"WITH wide AS ({_WIDE_SQL}) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS filled, count(*) AS rows FROM wide"
        for c in ("jdl__ttl", "jdl__pwg", "jdl__lpm_pass_name", "full_jdl_raw")
    )
)
def fill_counts(given: Given) -> DataFrame:
    flat = flatten_jdl(decode_jdl(given.mon_jdls), _WIDE_KEYS)
    return quality.fill_counts(flat, ["jdl__ttl", "jdl__pwg", "jdl__lpm_pass_name", "full_jdl_raw"])


# ---- contract -----------------------------------------------------------------------------


def _contract_jdl_sql() -> str:
    present = {"TTL", "CPUCores", "Price", "JobTag", "Packages", "PWG", "LPMPassName"}
    columns = ["o.job_id AS \"job_id\""]
    columns += [
        f"w.\"{key}\" AS \"{key}\"" if key in present else f"CAST(NULL AS VARCHAR) AS \"{key}\""
        for key in contract.JDL_KEYS
    ]
    columns += [
        "o.lpmjobtypeid AS _src_lpmjobtypeid", "CAST(NULL AS VARCHAR) AS full_jdl",
        "o.doc IS NOT NULL AS jdl_parse_ok", "CASE WHEN o.doc IS NULL THEN o.full_jdl END AS full_jdl_raw",
        "'load-1' AS _dlt_load_id", "sha256('load-1|' || o.job_id) AS _dlt_id",
    ]
    columns += [f"CAST(NULL AS VARCHAR) AS jdl__{name}" for name in contract.EXTRA_JDL]
    values = ", ".join(f"{_value(key)} AS \"{key}\"" for key in sorted(present))
    return (
        _DECODED + f"SELECT {', '.join(columns)} FROM obj o LEFT JOIN "
        f"(SELECT job_id, {values} FROM pairs GROUP BY job_id) w ON w.job_id = o.job_id"
    )


@query(f"SELECT * FROM ({SQL['job_info']})")
def contract_jobs(given: Given) -> DataFrame:
    return contract.project(given.job_info, contract.JOB_INFO)


@query(_contract_jdl_sql())
def contract_jdls(given: Given) -> DataFrame:
    """All 67 contract columns (two of them typed NULLs) and the passthrough tail."""
    parsed = jobs.parsed_table(decode_jdl(given.mon_jdls), jobs._served_keys(), "load-1")
    return contract.project(parsed, contract.MON_JDLS_PARSED)


def _live_columns(given: Given) -> DataFrame:
    """The live schema as the data makes it: one column per JDL key, plus bookkeeping."""
    census = quality.key_census(decode_jdl(given.mon_jdls)).select("column").distinct()
    jdl = census.select(F.lit("mon_jdls_parsed").alias("table"), "column", F.lit("string").alias("type"))
    base = schema_rows(given.mon_jdls.withColumn("ingest_host", F.lit("x")), "mon_jdls_parsed")
    return jdl.unionByName(base)


def _drift_sql() -> str:
    known = ", ".join(f"('{c}', {c in set(contract.MON_JDLS_PARSED.selected)})"
                      for c in sorted(contract.MON_JDLS_PARSED.known))
    return (
        _DECODED
        + f""", live AS (SELECT DISTINCT {_SNAKE_SQL} AS c, 'string' AS type FROM pairs
        UNION ALL VALUES ('job_id', 'bigint'), ('lpmjobtypeid', 'string'), ('full_jdl', 'string'), ('ingest_host', 'string')),
        known(c, selected) AS (VALUES {known})
        SELECT 'mon_jdls_parsed' AS "table", c AS "column", type,
          CASE WHEN starts_with(c, 'jdl__') THEN 'additive' ELSE 'informational' END AS kind
        FROM live WHERE c NOT IN (SELECT c FROM known)
        UNION ALL
        SELECT 'mon_jdls_parsed', c, NULL, 'subtractive' FROM known
        WHERE selected AND c NOT IN (SELECT c FROM live)"""
    )


@query(_drift_sql())
def contract_drift(given: Given) -> DataFrame:
    return drift(_live_columns(given), contract_rows(given.spark, [contract.MON_JDLS_PARSED]))


@query(
    f"""SELECT count(*) FILTER (kind = 'additive') AS additive,
    count(*) FILTER (kind = 'informational') AS informational,
    count(*) FILTER (kind = 'subtractive') AS subtractive,
    count(*) FILTER (kind = 'subtractive') = 0 AS applied,
    CASE WHEN count(*) FILTER (kind = 'subtractive') > 0 THEN 2 ELSE 0 END AS exit_code
    FROM ({_drift_sql()})"""
)
def drift_gate(given: Given) -> DataFrame:
    return drift_verdict(contract_drift(given))


# ---- times and ages -------------------------------------------------------------------------


@query(
    f"""SELECT job_id, epoch_ms(laststatuschangetimestamp + job_id % 1000) AS changed_at
    FROM ({SQL['trace']})"""
)
def millis_to_timestamp(given: Given) -> DataFrame:
    ms = F.col("laststatuschangetimestamp") + F.col("job_id") % 1000
    return given.trace.select("job_id", moments.from_millis(ms).cast("timestamp_ntz").alias("changed_at"))


@query(
    """SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN date_trunc('milliseconds', ts) END AS committed_at
    FROM events"""
)
def utc_text(given: Given) -> DataFrame:
    zone = F.when(F.col("event_id") % 5 == 0, " CET").otherwise(" UTC")
    text = F.concat(F.date_format(F.col("ts"), moments.UTC_TEXT), zone)
    return given.events.select(
        "event_id", moments.parse_utc(text).cast("timestamp_ntz").alias("committed_at")
    )


CUTOFF = datetime(1998, 3, 1)


@query(f"SELECT DISTINCT job_id FROM ({SQL['job_info']}) WHERE last_update < TIMESTAMP '1998-03-01'")
def old_jobs(given: Given) -> DataFrame:
    return retention.old_jobs(given.job_info, CUTOFF)


@query(
    f"""SELECT DISTINCT job_id FROM ({SQL['trace']})
    WHERE to_timestamp(laststatuschangetimestamp / 1000.0) < TIMESTAMPTZ '1998-03-01 00:00:00+00'"""
)
def old_traces(given: Given) -> DataFrame:
    return retention.old_traces(given.trace, CUTOFF)


# ---- generated rows ---------------------------------------------------------------------------

_NOW = "2026-07-15T00:00:00"


def _draw(name: str, span: int) -> str:
    return f"(('0x' || substr(md5('{name}:' || job_id), 1, 8))::BIGINT % {span})"


def _hundredths(name: str, span: int) -> str:
    return f"CAST({_draw(name, span)} / 100.0 AS DECIMAL(38,2))"


def _one_of(name: str, values: tuple[str, ...]) -> str:
    return f"{list(values)}[{_draw(name, len(values))} + 1]"


def _life() -> str:
    moment = f"1784073600 - {_draw('age', generator.MAX_AGE_DAYS * 86_400)}"
    moments = [f"({moment}) AS submitted"]
    for name, longest in generator.STRETCHES.items():
        moment += f" + {_draw(name, longest)}"
        moments.append(f"({moment}) AS {name}")
    return f"SELECT job_id, {', '.join(moments)} FROM (SELECT o_orderkey AS job_id FROM orders)"


@query(
    f"""SELECT job_id, {_draw('jdl_set', 50)} > 0 AS jdl_set, {_draw('trace_set', 25)} > 0 AS trace_set,
    {_one_of('status', generator.STATES)} AS status, submitted::BIGINT AS job_submit_timestamp,
    make_timestamp((settle * 1000000)::BIGINT) AS last_update, 'site-' || {_draw('site', 40)} AS site FROM ({_life()})"""
)
def generated_jobs(given: Given) -> DataFrame:
    ids = given.orders.select(F.col("o_orderkey").alias("job_id"))
    return generator.job_info_rows(ids, F.lit(_NOW).cast("timestamp_ntz"))


@query(
    f"""SELECT job_id, {_hundredths('grid efficiency', 10_001)}::DECIMAL(38,9) AS aliencpuefficiency,
    {_hundredths('cpu time', 9_000_000)}::DECIMAL(38,9) AS cputime, 'node' || {_draw('host', 300)} || '.example.org' AS host,
    {_draw('maxrss', 4_000_000)} AS maxrss, {_hundredths('cpu efficiency', 10_001)}::VARCHAR AS cpuefficiency,
    (save * 1000)::BIGINT AS finaltimestamp, job_id - {_draw('master', 1_000)} AS masterjobid,
    {_draw('pid', 4_194_303)} + 1 AS pid, (1 << {_draw('cpus', 5)})::INTEGER AS requestedcpus,
    {_draw('ttl', 96)} * 900 AS requestedttl, (setup * 1000)::BIGINT AS runningtimestamp,
    (run * 1000)::BIGINT AS savingtimestamp, (queued * 1000)::BIGINT AS startedtimestamp,
    {_draw('run', generator.STRETCHES['run'])}::INTEGER AS walltime, {_draw('maxvirt', 9_000_000)} AS maxvirt,
    'site-' || {_draw('site', 40)} AS site, (settle * 1000)::BIGINT AS laststatuschangetimestamp FROM ({_life()})"""
)
def generated_traces(given: Given) -> DataFrame:
    ids = given.orders.select(F.col("o_orderkey").alias("job_id"))
    return generator.trace_rows(ids, F.lit(_NOW).cast("timestamp_ntz"))


def _jdl_values() -> str:
    texts = [
        f"'{key}=' || " + (
            f"array_to_string([chr(34) || 'pkg@' || i || chr(34) for i in range({_draw('packages', 3)} + 1)], ',')"
            if key == "Packages" else f"'{key[:3]} ' || ({_draw('jdl', 1_000_000)} + {place})"
        )
        for place, key in enumerate(generator.jdl_keys())
    ]
    return f"[{', '.join(texts)}]"


@query(
    f"""SELECT job_id, 'type ' || {_draw('type', 20)} AS lpmjobtypeid, odd > 1 AS jdl_parse_ok,
    CASE WHEN odd > 1 THEN {len(generator.jdl_keys())} ELSE 0 END AS keys,
    CASE WHEN odd > 1 THEN md5(array_to_string({_jdl_values()}, chr(10))) END AS digest
    FROM (SELECT o_orderkey AS job_id, {_draw('oddness', generator.ODD_IN).replace('job_id', 'o_orderkey')} AS odd FROM orders)"""
)
def generated_jdls(given: Given) -> DataFrame:
    """All keys generated and decoded again; a digest of every key and value of a job."""
    ids = spread(given.orders, "o_orderkey").select(F.col("o_orderkey").alias("job_id"))
    decoded = decode_jdl(generator.mon_jdls_rows(ids))
    # entries in the order of their keys: a lookup for each of the keys makes a method that the JVM leaves uncompiled
    pairs = F.transform(
        F.sort_array(F.map_entries("jdl")), lambda e: F.concat_ws("=", e["key"], F.btrim(e["value"], F.lit("[]")))
    )
    return decoded.select(
        "job_id",
        "lpmjobtypeid",
        "jdl_parse_ok",
        F.coalesce(F.size(F.map_keys("jdl")), F.lit(0)).alias("keys"),
        F.when(F.col("jdl_parse_ok"), F.md5(F.concat_ws("\n", pairs).cast("binary"))).alias("digest"),
    )
