"""Compute-heavy steps: tasks of bounded size whatever the splits of the input hold."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemill import session
from telemill.plans.domain import Given
from telemill.session import spread


def held(df):
    return [row["count"] for row in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


def test_many_splits_of_one_row_group_are_spread(spark, tmp_path, monkeypatch):
    """A file of one row group cut into more splits than there are cores: all rows are in one of them."""
    path = f"{tmp_path}/events.parquet"
    spark.range(20_000).select(F.col("id").alias("event_id"), F.sha2(F.col("id").cast("string"), 256).alias("props")).coalesce(1).write.parquet(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = spark.read.parquet(path)
        assert df.rdd.getNumPartitions() > 8 and len(held(df)) == 1
        monkeypatch.setattr(session, "TASK_ROWS", 1_000)
        sizes = held(spread(df, "event_id"))
        assert len(sizes) == 20 and max(sizes) < 2_000 and sum(sizes) == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_enough_small_splits_stay(spark, tmp_path):
    path = f"{tmp_path}/events.parquet"
    spark.range(0, 1_000, 1, 12).write.parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    spark.conf.set("spark.sql.files.openCostInBytes", "64k")
    try:
        df = spark.read.parquet(path)
        assert spread(df, "id") is df
        assert sum(held(spread(df.filter("id < 0"), "id"))) == 0
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_generated_jdls_use_all_cores(spark, tmp_path):
    """One file of keys: the texts are made by several tasks."""
    from telemill.plans.queries_scan import generated_jdls

    spark.range(400).select(F.col("id").alias("o_orderkey")).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    found = generated_jdls(Given(spark, str(tmp_path)))
    assert len(held(found)) == 8 and found.filter("jdl_parse_ok").select("keys").distinct().count() == 1


def test_feeds_of_one_file_use_all_cores(spark, tmp_path):
    """Nested lists and JDLs of many keys are made and read by several tasks, each row once."""
    from telemill.plans.queries_feed import _many_keys, _results

    rows = spark.range(400).select(F.col("id").alias("event_id"), (F.col("id") % 5).alias("user_id"), F.lit("view").alias("event_type"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    given = Given(spark, str(tmp_path))
    for made in (_results(given), _many_keys(given)):
        sizes = held(made)
        assert len(sizes) == 8 and sum(sizes) == 400


def test_unlisted_spellings_are_looked_up_once_a_row(spark):
    """The work on spellings does not grow with the served keys; the first value that is not null counts."""
    from telemill.functions.jdl import flatten_served

    rows = spark.createDataFrame([(1, {"ttl": None, "Ttl": "7"})], "job_id int, jdl map<string,string>")

    def lambdas(keys):
        # the last projection holds the columns: without a function over the spellings for each of them
        top = flatten_served(rows, keys)._jdf.queryExecution().analyzed().toString().splitlines()[0]
        return top.count("lambdafunction")

    assert lambdas(["TTL", *(f"K{n}" for n in range(10))]) <= 1
    assert flatten_served(rows, ["TTL", "K1"]).select("jdl__ttl", "jdl__k1").collect() == [("7", None)]


def test_refused_texts_cost_the_reader_nothing(spark):
    """What cannot be an object or a literal stays out of the reader, and a value without the letter of a pattern out of the regex."""
    from telemill.functions.jdl import _OBJECT, decode_jdl, decode_with_json_module

    texts = [' \t{"a":1}', "{ }", "{\n}", '{"a":"E1.5"}', '{"a":[1.5E7]}', '{"a":0.0001}', '{"a":"b"', '{"a":1} x', '[{"a":1}]', "42", '"{}"', "", "{", '\\u007b\\"a\\":1}', '{\\"a\\":\\"b\\"}',
             '{\\"a\\":1} x', '{\\\\"a\\\\":1}', ' {\\"a\\":{\\"k\\":1,\\"k\\":2}}', '{"a":1e999}', '{"a":1.1234567891}', '{"a":"x\\\\"}', "{'a':1}", '{a:1}', ' {"a":1}', '{"a":[{"k":1},{"k":2}]}', '{"a":NaN}']
    rows = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "job_id int, full_jdl string")
    decoded = decode_jdl(rows)
    found = {r.job_id: (r.jdl, r.full_jdl_raw) for r in decoded.collect()}
    for i, text in enumerate(texts):
        value = decode_with_json_module(text)
        assert found[i] == (value, None if value is not None else text), text
    plan = decoded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(f", {_OBJECT})") == 2 and "Contains(" in plan


def test_only_texts_that_may_be_objects_go_to_the_authority(spark):
    """The authority sees no text that it must refuse by its first or last characters; the others go past it without their text."""
    from telemill.functions.jdl import _may_be_object, decode_jdl, decode_with_json_module

    body = '{"a":"b","n":{"k":1,"k":2}}'
    escaped = body.replace('"', '\\"')
    ends = ["", " ", "\\n", "\\t\\r", "\\u000A \\u0020", "\\u000d\\u0009", "\n", "\\\\n", "\\u00a0", " x", "\u2028", "]"]
    texts = [text + end for text in (body, escaped, escaped[:-1] + "\\u007D", escaped[:-1] + "\\u007d") for end in ends]
    texts += [start + text for text in (body, escaped, "\\u007b" + escaped[1:], "\\u007B" + escaped[1:]) for start in (" ", "\\n", "\\u0020", "\t", "\ufeff", "\x85", '"', "[")]
    texts += ["", "{", "}", "42", f"[{body}]", body[:-2], f'"{escaped}"', '{"a":NaN}', '{"a":1e999}\n', "null", " { } "]
    rows = spark.createDataFrame(list(enumerate(texts)), "job_id int, full_jdl string")
    asked = {r.job_id for r in rows.filter(_may_be_object(F.col("full_jdl"))).collect()}
    found = {r.job_id: (r.jdl, r.full_jdl_raw) for r in decode_jdl(rows).collect()}
    for i, text in enumerate(texts):
        value = decode_with_json_module(text)
        assert found[i] == (value, None if value is not None else text), text
        assert value is None or i in asked, text
    assert not asked & {i for i, text in enumerate(texts) if text in ("", "{", "}", "42", f"[{body}]", body[:-2], body + " x", escaped + " x")}
    plan = decode_jdl(rows)._jdf.queryExecution().optimizedPlan().toString().split("ArrowEvalPython", 1)[1]
    assert "full_jdl#" not in plan.split("Project [", 1)[1].split(", CASE", 1)[0]


def test_columns_that_no_row_fills_are_in_the_schema_and_in_no_file(spark, tmp_path):
    """A nightly run writes the columns of the keys it met; all others are null, also over an earlier value."""
    from telemill import contract
    from telemill.functions.names import jdl_column
    from telemill.plans import jobs
    from telemill.plans.lake import Lake

    lake = Lake(spark, f"{tmp_path}/lake")
    jobs_in = spark.createDataFrame([], "job_id long, last_update timestamp_ntz")
    trace = spark.createDataFrame([], "job_id long, laststatuschangetimestamp long")

    def night(run, *texts):
        rows = spark.createDataFrame([(i + 1, "t", text) for i, text in enumerate(texts)], "job_id long, lpmjobtypeid string, full_jdl string")
        jobs.run_nightly(lake, {"job_info": jobs_in, "trace": trace, "mon_jdls": rows}, run, {"mon_jdls": "0"})
        head = lake.head("mon_jdls_parsed")
        written = {name for part in head.parts for name in spark.read.parquet(f"{lake.root}/{part.path}").columns}
        return lake.read("mon_jdls_parsed"), written

    table, written = night("one", '{"TTL":"1","New":"x"}', '{"TTL":"2"}')
    assert {name for name in written if name.startswith("jdl__")} == {"jdl__ttl", "jdl__new"}
    served = {jdl_column(key) for key in contract.JDL_KEYS if key not in contract.UNSERVED_KEYS}
    assert served <= set(table.columns) and table.columns[7:] == sorted(table.columns[7:])
    assert table.select("job_id", "jdl__ttl", "jdl__new", "jdl__cpu_cores").orderBy("job_id").collect() == [(1, "1", "x", None), (2, "2", None, None)]
    # the second row comes again, without the key it had
    table, _ = night("two", '{"TTL":"3"}', '{"CPUCores":"4"}')
    assert table.select("job_id", "jdl__ttl", "jdl__new", "jdl__cpu_cores").orderBy("job_id").collect() == [(1, "1", "x", None), (2, None, None, "4")]
