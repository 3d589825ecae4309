"""The domain tables as projections of the given test tables, in Spark and in SQL.

``SQL`` holds the same projections as common table expressions for the checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemill.session import spread


class Given:
    """The given Parquet tables of one scale folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # ---- landing tables -----------------------------------------------------------

    @property
    def job_info(self) -> DataFrame:
        job = F.col("o_orderkey")
        return self.orders.select(
            job.alias("job_id"),
            F.lit(True).alias("jdl_set"),
            (job % 20 != 0).alias("trace_set"),
            F.col("o_orderstatus").alias("status"),
            F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("job_submit_timestamp"),
            F.col("o_orderdate").alias("last_update"),
            F.concat(F.lit("SITE_"), F.lpad((F.col("o_custkey") % 25 + 1).cast("string"), 2, "0")).alias("site"),
        )

    @property
    def trace(self) -> DataFrame:
        """One row per order: partial aggregation folds the lines before the shuffle."""
        shipped = F.unix_millis(F.col("l_shipdate").cast("timestamp"))
        return (
            self.lineitem.groupBy(F.col("l_orderkey").alias("job_id"))
            .agg(
                F.min(shipped).alias("startedtimestamp"),
                F.max(shipped).alias("laststatuschangetimestamp"),
                F.min("l_suppkey").alias("_host"),
                F.sum("l_quantity").cast("bigint").alias("walltime"),
            )
            .select(
                "job_id",
                F.concat(F.lit("wn"), F.lpad((F.col("_host") % 200 + 1).cast("string"), 4, "0")).alias("host"),
                "walltime",
                "startedtimestamp",
                "laststatuschangetimestamp",
            )
        )

    @property
    def mon_jdls(self) -> DataFrame:
        """JDL texts in every encoding the decoder must handle, chosen by the id."""
        return spread(self.events, "event_id").select(
            F.col("event_id").alias("job_id"),
            F.concat(F.lit("LPMJT_"), F.lpad((F.col("event_id") % 15 + 1).cast("string"), 3, "0")).alias(
                "lpmjobtypeid"
            ),
            jdl_text().alias("full_jdl"),
        )

    @property
    def prose_jdls(self) -> DataFrame:
        """Whole documents inside a JDL; odd ids in the escaped encoding."""
        clean = F.to_json(
            F.struct(
                F.col("source").alias("JobTag"),
                F.col("text").alias("Arguments"),
                F.array("lang").alias("InputData"),
            )
        )
        return spread(self.documents, "doc_id").select(
            F.col("doc_id").alias("job_id"),
            F.when(F.col("doc_id") % 2 == 0, clean).otherwise(escaped(clean)).alias("full_jdl"),
        )

    # ---- lake and book-keeping tables ----------------------------------------------

    @property
    def parents(self) -> DataFrame:
        """A landing ``job_info`` in which some parents are gone: low ids and every eleventh."""
        return self.job_info.filter((F.col("job_id") > 100) & (F.col("job_id") % 11 != 3))

    @property
    def children(self) -> DataFrame:
        """Landing rows without a key constraint: ids repeat."""
        return self.lineitem.select(F.col("l_orderkey").alias("job_id"), "l_linenumber", "l_partkey")

    @property
    def lake_keys(self) -> DataFrame:
        """A lake copy that lacks every seventh key."""
        return self.orders.filter(F.col("o_orderkey") % 7 != 0).select(F.col("o_orderkey").alias("job_id"))

    @property
    def probes(self) -> DataFrame:
        return self.events.filter("event_type = 'signup'").select(
            F.col("user_id").alias("host_id"),
            F.concat(F.lit("wn"), F.lpad((F.col("user_id") % 200 + 1).cast("string"), 4, "0")).alias("hostname"),
            F.unix_seconds(F.col("ts").cast("timestamp")).alias("last_updated"),
            F.col("event_id").alias("probe_id"),
        )

    @property
    def starts(self) -> DataFrame:
        return self.events.filter("event_type = 'error'").select(
            F.col("event_id").alias("job_id"),
            F.concat(F.lit("wn"), F.lpad((F.col("user_id") % 200 + 1).cast("string"), 4, "0")).alias("host"),
            F.unix_millis(F.col("ts").cast("timestamp")).alias("startedtimestamp"),
        )

    @property
    def commits(self) -> DataFrame:
        names = F.create_map(*[F.lit(x) for pair in COMMIT_TABLES.items() for x in pair])
        return self.events.select(
            names[F.col("event_type")].alias("table"),
            (F.col("event_id") * 1000 + 7).alias("snapshot_id"),
            F.col("event_id").alias("sequence_number"),
            F.col("ts").cast("timestamp").alias("committed_at"),
            F.when(F.col("event_id") % 4 == 0, "replace").otherwise("append").alias("operation"),
            F.when(F.col("event_id") % 3 == 0, F.col("event_id").cast("string")).alias("cursor_value"),
        )

    @property
    def runs(self) -> DataFrame:
        return self.events.select(
            F.concat(F.lit("flow_"), (F.col("user_id") % 3).cast("string")).alias("name"),
            F.when(F.col("event_type") == "error", "Failed").otherwise("Succeeded").alias("phase"),
            F.col("ts").alias("event_time"),
        )


# Names given to the event types when events stand for commits.
COMMIT_TABLES = {
    "signup": "job_info",
    "view": "trace",
    "purchase": "mon_jdls_parsed",
    "click": "site_sonar",
    "error": "scratch",
}


def escaped(text: Column) -> Column:
    """The text as the body of a JSON string literal."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))


def jdl_text() -> Column:
    job = F.col("event_id")
    k = F.regexp_extract("props", r"(\d+)", 1)
    clean = F.concat(
        F.lit('{"TTL":"'), (job % 5 * 600 + 3600).cast("string"),
        F.lit('","CPUCores":'), F.col("user_id").cast("string"),
        F.lit(',"Price":2.0,"JobTag":"'), F.col("event_type"),
        F.lit('","Packages":["A::v'), k, F.lit('", "süß"],"MetaData":{"pp": 13.6,"k":'), k,
        F.lit('},"PWG":null,"'), F.when(job % 2 == 0, "LPMPassName").otherwise("LPMPASSNAME"),
        F.lit('":"pass'), (job % 3).cast("string"), F.lit('","Extra":'), F.col("props"), F.lit("}"),
    )
    both = F.concat(
        F.lit('{"LPMPASSNAME":"a'), k, F.lit('","LPMPassName":null,"TTL":"'), job.cast("string"), F.lit('"}')
    )
    # long strings, long lists and many keys inside values
    wide = F.concat(
        F.lit('{"LPMPassName":"wide","TTL":"60","Packages":["'), F.repeat(F.lit("x"), 2500), F.lit('","'), k, F.lit('"],"MetaData":{"s":"'),
        F.repeat(F.lit("a, "), 1500), F.lit('","n":['), F.repeat(F.lit("7,"), 2000), k, F.lit("]}}"),
    )
    case = job % 20
    return (
        F.when(case == 0, F.lit(None).cast("string"))
        .when(case == 1, F.left(clean, F.length(clean) - 5))
        .when(case == 2, F.concat(clean, F.lit(" trailing")))
        .when(case == 3, F.concat(F.lit("["), clean, F.lit("]")))
        .when(case == 4, F.lit("42"))
        .when(case == 5, both)
        .when(case == 6, F.concat(F.lit('{"TTL":"1","TTL":"'), k, F.lit('"}')))
        .when(case.between(7, 10), escaped(clean))
        .when(case == 11, F.concat(escaped(clean), F.lit(" not valid json")))
        .when(case == 12, wide)
        .otherwise(clean)
    )


JDL_TEXT_SQL = """
SELECT event_id AS job_id, 'LPMJT_' || lpad((event_id % 15 + 1)::VARCHAR, 3, '0') AS lpmjobtypeid,
  CASE
    WHEN event_id % 20 = 0 THEN NULL
    WHEN event_id % 20 = 1 THEN left(clean, length(clean) - 5)
    WHEN event_id % 20 = 2 THEN clean || ' trailing'
    WHEN event_id % 20 = 3 THEN '[' || clean || ']'
    WHEN event_id % 20 = 4 THEN '42'
    WHEN event_id % 20 = 5 THEN '{"LPMPASSNAME":"a' || k || '","LPMPassName":null,"TTL":"' || event_id || '"}'
    WHEN event_id % 20 = 6 THEN '{"TTL":"1","TTL":"' || k || '"}'
    WHEN event_id % 20 BETWEEN 7 AND 10 THEN replace(replace(clean, '\\', '\\\\'), '"', '\\"')
    WHEN event_id % 20 = 11 THEN replace(replace(clean, '\\', '\\\\'), '"', '\\"') || ' not valid json'
    WHEN event_id % 20 = 12 THEN '{"LPMPassName":"wide","TTL":"60","Packages":["' || repeat('x', 2500) || '","' || k
      || '"],"MetaData":{"s":"' || repeat('a, ', 1500) || '","n":[' || repeat('7,', 2000) || k || ']}}'
    ELSE clean END AS full_jdl
FROM (
  SELECT event_id, k,
    '{"TTL":"' || (event_id % 5 * 600 + 3600) || '","CPUCores":' || user_id || ',"Price":2.0,"JobTag":"'
    || event_type || '","Packages":["A::v' || k || '", "süß"],"MetaData":{"pp": 13.6,"k":' || k
    || '},"PWG":null,"' || CASE WHEN event_id % 2 = 0 THEN 'LPMPassName' ELSE 'LPMPASSNAME' END
    || '":"pass' || event_id % 3 || '","Extra":' || props || '}' AS clean
  FROM (SELECT *, regexp_extract(props, '(\\d+)', 1) AS k FROM events)
)
"""

PROSE_SQL = """
SELECT doc_id AS job_id,
  CASE WHEN doc_id % 2 = 0 THEN clean ELSE replace(replace(clean, '\\', '\\\\'), '"', '\\"') END AS full_jdl
FROM (
  SELECT doc_id, '{"JobTag":' || to_json(source) || ',"Arguments":' || to_json(text)
    || ',"InputData":[' || to_json(lang) || ']}' AS clean
  FROM documents
)
"""


def decoded_sql(source: str) -> str:
    """Common table expressions ``obj`` and ``pairs`` over the relation ``source``."""
    return f"""
texts AS ({source}),
direct AS (
  SELECT *, json_valid(full_jdl) AS plain,
    CASE WHEN json_valid('"' || full_jdl || '"') THEN json_extract_string('"' || full_jdl || '"', '$') END AS body
  FROM texts
),
obj AS (
  SELECT * EXCLUDE (plain, body),
    CASE WHEN plain THEN CASE WHEN json_type(full_jdl) = 'OBJECT' THEN full_jdl END
         WHEN body IS NOT NULL AND json_valid(body) THEN CASE WHEN json_type(body) = 'OBJECT' THEN body END
    END AS doc
  FROM direct
),
listed AS (
  SELECT job_id, unnest(json_keys(doc)) AS k, unnest(json_extract(doc, '$.*')) AS v,
    unnest(range(len(json_keys(doc)))) AS pos
  FROM obj WHERE doc IS NOT NULL
),
single AS (
  SELECT job_id, k, min(pos) AS pos, arg_max(
    CASE json_type(v) WHEN 'VARCHAR' THEN 's' || (v ->> '$') WHEN 'NULL' THEN 'n' ELSE 's' || v::VARCHAR END, pos
  ) AS tagged
  FROM listed GROUP BY job_id, k
),
valued AS (
  SELECT job_id, k, pos, CASE WHEN tagged <> 'n' THEN substr(tagged, 2) END AS v FROM single
),
pairs AS (
  SELECT job_id, k, v FROM valued WHERE lower(k) <> 'lpmpassname'
  UNION ALL
  SELECT job_id, 'LPMPassName', arg_min(v, pos) FILTER (v IS NOT NULL)
  FROM valued WHERE lower(k) = 'lpmpassname' GROUP BY job_id
)
"""


SQL = {
    "job_info": """
SELECT o_orderkey AS job_id, true AS jdl_set, o_orderkey % 20 <> 0 AS trace_set, o_orderstatus AS status,
  epoch(o_orderdate)::BIGINT AS job_submit_timestamp, o_orderdate AS last_update,
  'SITE_' || lpad((o_custkey % 25 + 1)::VARCHAR, 2, '0') AS site
FROM orders""",
    "trace": """
SELECT l_orderkey AS job_id, 'wn' || lpad((min(l_suppkey) % 200 + 1)::VARCHAR, 4, '0') AS host,
  sum(l_quantity)::BIGINT AS walltime, epoch_ms(min(l_shipdate)) AS startedtimestamp,
  epoch_ms(max(l_shipdate)) AS laststatuschangetimestamp
FROM lineitem GROUP BY l_orderkey""",
    "mon_jdls": JDL_TEXT_SQL,
    "children": "SELECT l_orderkey AS job_id, l_linenumber, l_partkey FROM lineitem",
    "lake_keys": "SELECT o_orderkey AS job_id FROM orders WHERE o_orderkey % 7 <> 0",
    "probes": """
SELECT user_id AS host_id, 'wn' || lpad((user_id % 200 + 1)::VARCHAR, 4, '0') AS hostname,
  floor(epoch(ts))::BIGINT AS last_updated, event_id AS probe_id
FROM events WHERE event_type = 'signup'""",
    "starts": """
SELECT event_id AS job_id, 'wn' || lpad((user_id % 200 + 1)::VARCHAR, 4, '0') AS host,
  epoch_us(ts) // 1000 AS startedtimestamp
FROM events WHERE event_type = 'error'""",
    "commits": """
SELECT CASE event_type WHEN 'signup' THEN 'job_info' WHEN 'view' THEN 'trace'
    WHEN 'purchase' THEN 'mon_jdls_parsed' WHEN 'click' THEN 'site_sonar' ELSE 'scratch' END AS "table",
  event_id * 1000 + 7 AS snapshot_id, event_id AS sequence_number, ts AS committed_at,
  CASE WHEN event_id % 4 = 0 THEN 'replace' ELSE 'append' END AS operation,
  CASE WHEN event_id % 3 = 0 THEN event_id::VARCHAR END AS cursor_value
FROM events""",
    "runs": """
SELECT 'flow_' || user_id % 3 AS name, CASE WHEN event_type = 'error' THEN 'Failed' ELSE 'Succeeded' END AS phase,
  ts AS event_time
FROM events""",
}
SQL["parents"] = f"SELECT * FROM ({SQL['job_info']}) WHERE job_id > 100 AND job_id % 11 <> 3"


def ctes(*names: str) -> str:
    """A WITH clause of the named domain relations."""
    return "WITH " + ", ".join(f"{name} AS ({SQL[name]})" for name in names) + " "
