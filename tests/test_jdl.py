"""Decoding against the JSON authority, golden cases and naming."""

from __future__ import annotations

import json
import time

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from telemill.contract import JDL_KEYS, MON_JDLS_PARSED, UNSERVED_KEYS
from telemill.functions.jdl import decode_jdl, flatten_jdl
from telemill.functions.names import jdl_column, snake_column, snake_name


def as_body(text: str) -> str:
    """The text as the body of a JSON string literal."""
    return json.dumps(text)[1:-1]


def reference_decode(raw):
    """Written apart from the library: the expected (map, ok, raw)."""
    if raw is None:
        return None, False, None
    try:
        try:
            value = json.loads(raw)
        except ValueError:
            value = json.loads(json.loads('"' + raw + '"'))
        assert isinstance(value, dict)
    except (ValueError, AssertionError):
        return None, False, raw
    out = {}
    for key, item in value.items():
        text = item if item is None or isinstance(item, str) else json.dumps(item, separators=(",", ":"), ensure_ascii=False)
        out[key] = text
    variants = [k for k in out if k.casefold() == "lpmpassname"]
    if variants and variants != ["LPMPassName"]:
        merged = next((out[k] for k in variants if out[k] is not None), None)
        for k in variants:
            del out[k]
        out["LPMPassName"] = merged
    return out, True, None


def check(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "job_id long, full_jdl string")
    rows = {r.job_id: r for r in decode_jdl(df).collect()}
    assert len(rows) == len(texts)
    for i, raw in enumerate(texts):
        want = reference_decode(raw)
        got = (rows[i].jdl, rows[i].jdl_parse_ok, rows[i].full_jdl_raw)
        assert got == want, raw


GOLDEN = [
    '{"TTL":"3600","LPMPassName":"pass1"}',
    '{"TTL":"7200","LPMPASSNAME":"pass2"}',
    '{"LPMPassName":null,"LPMPASSNAME":"x"}',
    '{"LPMPassName":"y","lpmpassname":null}',
    '{"lpmPassName":null,"LPMPASSNAME":null}',
    '{"LPMPaßName":"sharp"}',
    as_body('{"TTL": 72000, "Output": "hist/run?.dat"}'),
    '{\\"Output\\":\\"hist\\/run?.dat\\"}',
    '{\\"TTL\\": \\"3600\\", not valid json',
    '{"Comment":"a \\\\n b"}',
    None,
    '["TTL", "3600"]',
    "42",
    '"text"',
    "null",
    "",
    '{"TTL": "1800", "CPUCores": "2"',
    '{"a":1} trailing',
    '{"a":1}]',
    '{"a":1},{"b":2}',
    '{"a":"1","a":"2"}',
    '{"a":"1","b":"x","a":"2","LPMPASSNAME":"p","LPMPASSNAME":"q"}',
    '{"a":72000,"b":2.0,"c":true,"d":["A::v1", "B::v2"],"e":{"C": "pp 13.6","Y":2026},"f":null,"g":["süß"]}',
    '{"a":1e5,"b":1E-7,"c":12345678.5,"d":0.00012,"e":1e400,"f":-0,"g":-0.0,"h":123456789012345678901234567890}',
    '{"a":[1e-7, {"b": 1.5E10}],"b":"1.0E7","c":1.7976931348623157e308}',
    '{"a":NaN,"b":[Infinity, -Infinity]}',
    as_body('{"a":NaN,"b":1e22}'),
    '{"a":["\\u001f", "\\u007f"]}',
    '{"a":["\\ud83d\\ude00"],"b":"\\ud83d\\ude00"}',
    "{'a':1}",
    '{"a":01}',
    '{"a":"x\ty"}',
    '{"a":1,}',
    "  {\"a\" : 1}\n",
    '{"a":{"b":[1,{"c":"d"}]}}',
    '{}',
    '{"":1}',
    '\\u007b\\"a\\":1}',
    'x","w":"y',
]


def test_golden_cases(spark):
    check(spark, GOLDEN)


def test_without_the_authority_only_rare_tokens_differ(spark):
    df = spark.createDataFrame([(1, GOLDEN[0]), (2, GOLDEN[6]), (3, "{")], "job_id long, full_jdl string")
    rows = {r.job_id: r for r in decode_jdl(df, exact_tokens=False).collect()}
    assert rows[1].jdl["LPMPassName"] == "pass1"
    assert rows[2].jdl == {"TTL": "72000", "Output": "hist/run?.dat"}
    assert not rows[3].jdl_parse_ok and rows[3].full_jdl_raw == "{"


VALUES = st.recursive(
    st.none() | st.booleans() | st.integers(-(10**20), 10**20) | st.floats(allow_nan=False, allow_infinity=False)
    | st.text(st.characters(blacklist_categories=("Cs",)), max_size=8),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text("abcé", max_size=3), inner, max_size=3),
    max_leaves=6,
)


@settings(max_examples=5, deadline=None, phases=(Phase.generate,), derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(st.sampled_from(["TTL", "LPMPassName", "LPMPASSNAME", "x y"]), VALUES, max_size=4), min_size=30, max_size=30))
def test_any_object_decodes_as_the_authority_does(spark, objects):
    texts = [json.dumps(o) for o in objects[:10]]
    texts += [json.dumps(o, ensure_ascii=False, indent=1) for o in objects[10:20]]
    texts += [as_body(json.dumps(o)) for o in objects[20:]]
    check(spark, texts + [t[:-1] for t in texts] + [t + "}" for t in texts])


def test_binary_texts(spark):
    rows = [(1, b'{"a": "\xc3\xbc"}'), (2, b'{"a": "\xff"}'), (3, b'{\\"a\\": 1}'), (4, None)]
    df = spark.createDataFrame(rows, "job_id long, full_jdl binary")
    got = {r.job_id: r for r in decode_jdl(df).collect()}
    assert got[1].jdl == {"a": "ü"} and got[1].full_jdl_raw is None
    assert not got[2].jdl_parse_ok and bytes(got[2].full_jdl_raw) == rows[1][1]
    assert not got[3].jdl_parse_ok
    assert not got[4].jdl_parse_ok and got[4].full_jdl_raw is None


def test_a_filter_above_the_decode_does_not_copy_the_parse(spark):
    df = spark.createDataFrame([(1, '{"a":"b"}')], "job_id long, full_jdl string")
    twice = decode_jdl(decode_jdl(df).filter("jdl_parse_ok").select("job_id", F.to_json("jdl").alias("full_jdl")))
    plan = twice.filter("jdl_parse_ok")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") < 40
    assert twice.filter("jdl_parse_ok").count() == 1


def test_flatten_groups_spellings(spark):
    df = spark.createDataFrame([(1, '{"CPUCores":"4","CPU_Cores":null,"L":["a"]}')], "job_id long, full_jdl string")
    flat = flatten_jdl(decode_jdl(df), ["CPUCores", "cpu_cores", "L", "Absent"])
    row = flat.collect()[0]
    assert (row.jdl__cpu_cores, row.jdl__l, row.jdl__absent) == ("4", '["a"]', None)
    assert flat.columns.count("jdl__cpu_cores") == 1


# fixed pairs
NAMES = {
    "CPUCores": "cpu_cores",
    "O2DPG_ASYNC_RECO_TAG": "o2_dpg_async_reco_tag",
    "HYJobID": "hy_job_id",
    "TTL": "ttl",
    "LPMInteractionType": "lpm_interaction_type",
    "JDLPath": "jdl_path",
    "SeNumber": "se_number",
}


@pytest.mark.parametrize("name", NAMES)
def test_names(name):
    assert snake_name(name) == NAMES[name]


def test_both_forms_of_the_naming_rule_agree(spark):
    keys = [*JDL_KEYS, *NAMES, "1st", "a-b", "x__y", "Foo.Bar", "é"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for row in df.select("k", snake_column(F.col("k")).alias("n")).collect():
        assert row.n == snake_name(row.k)


def test_contract_counts():
    columns = MON_JDLS_PARSED.columns
    assert len(columns) == 67
    assert sum(v is not None for v in columns.values()) == 65
    assert [k for k, v in columns.items() if v is None] == list(UNSERVED_KEYS)
    assert len(MON_JDLS_PARSED.passthrough) == 44
    assert len(set(MON_JDLS_PARSED.selected)) == 109
    assert columns["LPMPassName"] == jdl_column("LPMPassName") == "jdl__lpm_pass_name"


def test_repeated_keys_inside_a_value(spark):
    texts = ['{"M":{"a":1,"a":2}}', '{"M":[{"a":1},{"a":2}]}', '{"M":{"x":{"b":1,"c":0,"b":[3]}}}', '{"M":{"q\\"":1,"q\\"":2}}', '{"M":{"a":{"a":1}}}']
    rows = spark.createDataFrame(list(enumerate(texts)), "job_id int, full_jdl string")
    got = {r.job_id: r.jdl["M"] for r in decode_jdl(rows).collect()}
    assert got == {0: '{"a":2}', 1: '[{"a":1},{"a":2}]', 2: '{"x":{"b":[3],"c":0}}', 3: '{"q\\"":2}', 4: '{"a":{"a":1}}'}


def test_a_condition_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "jdls")
    spark.range(20).selectExpr("id AS job_id", "'{}' AS full_jdl").write.parquet(path)
    frame = decode_jdl(spark.read.parquet(path), where=F.col("job_id") > 15)
    assert "GreaterThan(job_id,15)" in frame._jdf.queryExecution().executedPlan().toString() and frame.count() == 4


def test_no_value_is_too_long(spark):
    """Long strings, lists and objects inside values, repeated keys among very many: as the authority, and soon."""
    keys = {f"k{i}": i for i in range(20_000)}
    many, twice = json.dumps(keys), json.dumps(keys)[:-1] + ', "k7": "last"}'
    objects = [
        '{"InputData":["%s","y"],"TTL":"1"}' % ("x" * 1_000_000),
        '{"InputData":["%s"]}' % ('\\\\\\"' * 200_000),
        json.dumps({"InputData": ["a"] * 100_000, "M": {"s": "q" * 1_000_000, "t": "\\" * 100_000}}),
        '{"M":%s}' % many,
        '{"M":%s}' % twice,
        many,
        twice,
        '{"M":[%s]}' % ",".join('{"a":"b:c"}' for _ in range(50_000)),
        '{"M":{"a":":","b":"\\":","a":","}}',
    ]
    started = time.time()
    check(spark, [*objects, as_body(objects[0])])
    assert time.time() - started < 90
