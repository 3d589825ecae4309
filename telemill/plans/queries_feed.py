"""Queries on feeds: dumps as a data source, nested lists, unbounded keys, balanced extraction, changes behind a cursor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemill.functions.jdl import OTHER, decode_jdl, entry_of, flatten_served
from telemill.operators import digests
from telemill.plans import jobs
from telemill.plans.domain import Given, ctes
from telemill.plans.queries_lake import new_lake, stored_dumps
from telemill.plans.registry import query
from telemill.session import scratch, ship, spread
from telemill.sources import dump_feed, nested, ranges
from telemill.streaming import ingest

# ---- dumps as a data source ---------------------------------------------------------------------------

_FEED_SQL = """SELECT 1700000000 + event_id // 500 AS epoch, user_id AS host_id, event_type AS ce_name,
  floor(epoch(ts))::BIGINT AS last_updated FROM events"""


def _fields(lines: DataFrame) -> DataFrame:
    doc = F.try_parse_json("line")
    of = lambda name, kind: F.try_variant_get(doc, f"$.{name}", kind).alias(name)
    return lines.filter(F.schema_of_variant(doc).startswith("OBJECT")).select(
        "epoch", of("host_id", "bigint"), of("ce_name", "string"), of("last_updated", "bigint")
    )


@query(f"SELECT * FROM ({_FEED_SQL}) WHERE epoch > 1700000001")
def dump_source(given: Given) -> DataFrame:
    """The dumps of a folder above a mark, read by the data source."""
    ship(given.spark)
    folder = scratch(given.spark, "feed")
    stored_dumps(given, folder)
    return _fields(dump_feed.dump_rows(given.spark, folder, after=1_700_000_001))


@query(_FEED_SQL)
def dump_source_stream(given: Given) -> DataFrame:
    """The same folder as a stream that is stopped and started again while dumps arrive: each is read once."""
    ship(given.spark)
    root = scratch(given.spark, "feed")
    for where in ("path < 'site-sonar-1700000003'", "path >= 'site-sonar-1700000003'", "false"):
        stored_dumps(given, f"{root}/feed", where)
        rows = _fields(dump_feed.dump_stream(given.spark, f"{root}/feed"))
        ingest.write_available(rows, f"{root}/out", f"{root}/state")
    return given.spark.read.parquet(f"{root}/out")


# ---- nested lists ---------------------------------------------------------------------------------------


def _results(given: Given) -> DataFrame:
    """Events as test results: lists of objects that hold lists, lists of lists, and a field that is a list at times."""
    event = F.col("event_id")
    gpu = lambda k: F.struct(
        F.concat("event_type", F.lit(str(k))).alias("name"), F.array(event % 3, event % 5 + k).alias("fans"), F.struct((event % 7).alias("code")).alias("os")
    )
    doc = F.to_json(
        F.struct(
            F.when(event % 4 != 0, F.array(gpu(0), gpu(1))).alias("gpus"),
            F.array(F.array(F.col("user_id").cast("string")), F.array("event_type", F.lit("x"))).alias("grid"),
        )
    )
    mixed = F.when(event % 2 == 0, F.lit(',"mixed":"none"}')).otherwise(F.concat(F.lit(',"mixed":["'), "event_type", F.lit('"]}')))
    texts = spread(given.events, "event_id").select("event_id", doc.alias("doc"), mixed.alias("mixed"))
    return texts.select("event_id", F.parse_json(F.concat(F.expr("left(doc, length(doc) - 1)"), "mixed")).alias("v"))


_NESTED_SQL = """
WITH gpus AS (SELECT event_id::VARCHAR AS parent, k::INTEGER AS idx, event_type || k AS name, event_id % 7 AS code, event_id,
    sha256(event_id || '|t__gpus|' || k) AS id FROM events, (VALUES (0), (1)) g(k) WHERE event_id % 4 <> 0),
grid AS (SELECT event_id::VARCHAR AS parent, k::INTEGER AS idx, sha256(event_id || '|t__grid|' || k) AS id, user_id, event_type
    FROM events, (VALUES (0), (1)) g(k)),
items AS (
  SELECT 't__gpus' AS "table", parent, idx, name AS value, code::VARCHAR AS code FROM gpus
  UNION ALL SELECT 't__gpus__fans', id, i::INTEGER, (CASE i WHEN 0 THEN event_id % 3 ELSE event_id % 5 + idx END)::VARCHAR, NULL
    FROM gpus, (VALUES (0), (1)) f(i)
  UNION ALL SELECT 't__grid', parent, idx, NULL, NULL FROM grid
  UNION ALL SELECT 't__grid__list', id, 0, CASE idx WHEN 0 THEN user_id::VARCHAR ELSE event_type END, NULL FROM grid
  UNION ALL SELECT 't__grid__list', id, 1, 'x', NULL FROM grid WHERE idx = 1
  UNION ALL SELECT 't__mixed', event_id::VARCHAR, 0, event_type, NULL FROM events WHERE event_id % 2 = 1
)
SELECT "table", parent, idx, value, code FROM items"""


@query(_NESTED_SQL)
def nested_children(given: Given) -> DataFrame:
    """Every list of drifting documents as a child table, with the id of the row that holds it."""
    tables = nested.child_tables(_results(given), F.col("event_id"), "v", "t")
    out = []
    for name, rows in sorted(tables.items()):
        value = next((c for c in ("value", "name") if c in rows.columns), None)
        code = F.col("os__code") if "os__code" in rows.columns else F.lit(None).cast("string")
        shown = F.col(value) if value else F.lit(None).cast("string")
        out.append(rows.select(F.lit(name).alias("table"), F.col("_parent_id").alias("parent"), F.col("_list_idx").alias("idx"), shown.alias("value"), code.alias("code")))
    rows = out[0]
    for more in out[1:]:
        rows = rows.unionByName(more)
    return rows


# ---- any number of keys ------------------------------------------------------------------------------


def _many_keys(given: Given) -> DataFrame:
    """JDLs that each have a key of their own, a key of a hundred, and an unlisted spelling of a served key."""
    event = F.col("event_id").cast("string")
    text = F.concat(
        F.lit('{"TTL":"'), (F.col("event_id") % 5).cast("string"), F.lit('","Cpu_Cores":'), F.col("user_id").cast("string"),
        F.lit(',"Own'), event, F.lit('":"'), F.col("event_type"), F.lit('","K'), (F.col("event_id") % 100).cast("string"), F.lit('":['), event, F.lit("]}"),
    )
    rows = spread(given.events, "event_id")
    return rows.select(F.col("event_id").alias("job_id"), F.lit("t").alias("lpmjobtypeid"), text.alias("full_jdl"))


@query(
    """SELECT event_id AS job_id, (event_id % 5)::VARCHAR AS ttl, user_id::VARCHAR AS cores, 2 AS others, event_type AS own,
    '[' || event_id || ']' AS of_hundred FROM events"""
)
def overflow_keys(given: Given) -> DataFrame:
    """As many keys as rows: the served ones are columns, all others stand in the map."""
    flat = flatten_served(decode_jdl(_many_keys(given)), ["TTL", "CPUCores"])
    at = lambda key: F.element_at(OTHER, key)
    event = F.col("job_id")
    return flat.select(
        "job_id", F.col("jdl__ttl").alias("ttl"), F.col("jdl__cpu_cores").alias("cores"), F.size(OTHER).alias("others"),
        at(F.concat(F.lit("Own"), event.cast("string"))).alias("own"), at(F.concat(F.lit("K"), (event % 100).cast("string"))).alias("of_hundred"),
    )


@query(
    """SELECT event_id AS job_id, user_id::VARCHAR AS cores, CASE WHEN event_id % 100 = 7 THEN '[' || event_id || ']' END AS k7,
    CASE WHEN event_id % 100 = 7 AND event_id % 2 = 1 THEN 1 ELSE 2 END AS others,
    (SELECT count(*) + count(DISTINCT event_id % 100) + 2 FROM events) AS keys FROM events"""
)
def overflow_nightly(given: Given) -> DataFrame:
    """Two nightly runs, the second with a key that became a column: its value is found where either run put it."""
    store, rows = new_lake(given, "keys"), _many_keys(given)
    landing = {"job_info": given.job_info.filter("job_id < 0"), "trace": given.trace.filter("job_id < 0")}
    jobs.run_nightly(store, landing | {"mon_jdls": rows.filter("job_id % 2 = 0")}, "night-1", evolve=False)
    late = rows.filter("job_id % 2 = 1").withColumn("job_id", F.col("job_id") + 10**9)
    jobs.run_nightly(store, landing | {"mon_jdls": late}, "night-2", evolve=False, promoted=["K7"])
    table, keys = store.read("mon_jdls_parsed"), store.read(jobs.KEYS).agg(F.count_distinct("key")).scalar()
    return table.select(
        (F.col("job_id") % 10**9).alias("job_id"), F.col("jdl__cpu_cores").alias("cores"), entry_of("K7", table.columns).alias("k7"),
        F.size(OTHER).alias("others"), keys.alias("keys"),
    )


# ---- balanced extraction, changes behind a cursor ----------------------------------------------------

RANGES = 16


def _skewed(given: Given) -> DataFrame:
    """Ids that lie ever further apart: half of all rows are in a thousandth of the id range.

    A cube of a key above 2,097,151 is no bigint any more, so the ids are decimals.
    """
    key = F.col("o_orderkey").cast("decimal(19,0)")
    return given.orders.select((key * key * key).alias("job_id"), "o_custkey")


@query(f"""SELECT {RANGES}::BIGINT AS ranges, count(*) AS rows, true AS each_once, true AS balanced FROM orders""")
def extraction_ranges(given: Given) -> DataFrame:
    """Ranges of a skewed key: each row in one, the largest at most 1.2 times the mean."""
    rows = _skewed(given)
    found = ranges.balanced_ranges(rows, "job_id", RANGES)
    counts = ranges.range_counts(rows, "job_id", found)
    total = F.sum("rows")
    return counts.agg(
        F.count("*").alias("ranges"), total.alias("rows"), (F.count_if(F.col("part").isNull()) == 0).alias("each_once"),
        (F.max("rows") * RANGES <= 1.2 * total).alias("balanced"),
    )


_MOVED = "CASE WHEN job_id % 997 = 5 THEN 'moved' ELSE status END"


@query(
    ctes("job_info")
    + f""", hit AS (SELECT DISTINCT job_id // 500 AS r FROM job_info WHERE job_id % 997 = 5 AND (job_id // 500) % 2 = 0)
    SELECT job_id, {_MOVED} AS status FROM job_info WHERE job_id // 500 IN (SELECT r FROM hit)"""
)
def changed_behind_cursor(given: Given) -> DataFrame:
    """Rows behind a key cursor that changed at the source: the ranges due this run that differ, whole, and no others."""
    rows = given.job_info.select("job_id", "status")
    stored = digests.range_digests(rows, "job_id", 500, rows.columns)
    source = rows.withColumn("status", F.expr(_MOVED))
    return digests.changed_rows(source, stored, "job_id", 500, rows.columns, F.col("range") % 2 == 0)


@query(
    ctes("job_info")
    + """, l AS (SELECT * FROM job_info WHERE job_id % 401 <> 6),
    r AS (SELECT * REPLACE (CASE WHEN job_id % 613 = 0 THEN 'X' ELSE status END AS status) FROM job_info WHERE job_id % 701 <> 6)
    SELECT CASE WHEN r.job_id IS NULL THEN 'missing' WHEN l.job_id IS NULL THEN 'extra'
      WHEN l.status = r.status THEN 'same' ELSE 'changed' END AS verdict, count(*) AS keys
    FROM l FULL JOIN r ON r.job_id = l.job_id GROUP BY 1"""
)
def reconcile_ranges(given: Given) -> DataFrame:
    """The verdict of a reconciliation that reads a second time only where digests differ."""
    rows = given.job_info
    other = rows.withColumn("status", F.when(F.col("job_id") % 613 == 0, "X").otherwise(F.col("status")))
    return digests.reconcile_by_ranges(rows.filter("job_id % 401 <> 6"), other.filter("job_id % 701 <> 6"), "job_id", rows.columns, 64)[0]
