"""JSON functions, compared with a JSON parser on awkward texts."""

import json

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from fixtures import NEW, OLD, ORDER_EVENT, ORDER_SCHEMA, change, rows
from millrace.functions.jsons import is_json, json_parse, json_value, json_values, register_json_value
from millrace.functions.scalars import minus_millis, parse_iso_seconds
from millrace.operators.cdc import cdc_dead_letters, cdc_unpack
from millrace.operators.rows import split_by_validity
from millrace.operators.windows import tumbling_count
from millrace.sinks.writers import as_json_value
from millrace.sources.endpoints import bad_events, json_rows

TEXTS = [
    '{"a":1}', '{"a":1} x', '{"a":1}{"b":2}', "{'a':1}", '{"a":NaN}', "NaN", "Infinity", "-Infinity", "INF",
    '{"a":1,"a":2}', "", "  ", "null", "1", '"x"', "[1]", '[{"a":1}]', '{"a":01}', '{"a":"x\ny"}', '{"a":1,}',
    "{a:1}", '﻿{"a":1}', '{"a":{"b":1}}', '{"a":[1]}', '{"a":"{x"}', '{"a":null}', '{"a":+1}', '{"a":.5}',
    '{"a":1 /*c*/}', ' {"a":"s"} ', '\n\t{"a":1}\r\n', '{"a":1', '{"a":"\\x"}', '{"a":"tab\t"}', "1],[2",
    '1},{"v":2', "1,2", '1,"k":2', '{"a":INF}', '{"a":-INF}', '{"a":+Infinity}', '{"a":"NaN INF"}',
    '{"a":NaN,"b":"INF"}', '{"a":-Infinity}', '{"a":1e+5}', '{"a":NaN,"b":1e+5}', '\xa0{"a":1}', '{"a":"\\"INF"}',
    "]", "}", "[", "{", ",", '"', '"]', "\\",
]


def parses(text):
    try:
        json.loads(text)
        return True
    except ValueError:
        return False


def test_validity(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t STRING")
    wrong = [r.t for r in df.withColumn("ok", is_json(F.col("t"))).collect() if r.ok != parses(r.t)]
    assert wrong == []


def test_null_and_broken_utf8_are_not_json(spark):
    df = spark.sql("SELECT CAST(NULL AS STRING) AS t UNION ALL SELECT CAST(X'7B2261223A22FF227D' AS STRING)")
    assert rows(df.select(is_json(F.col("t")))) == [(False,), (False,)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet='{}[]",:0123eE+-.nulltrefasNI \\', max_size=12), min_size=50, max_size=200))
def test_validity_of_random_texts(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    wrong = [r.t for r in df.withColumn("ok", is_json(F.col("t"))).collect() if r.ok != parses(r.t)]
    assert wrong == []


def test_split_loses_nothing(spark):
    df = spark.createDataFrame([(t,) for t in [*TEXTS, None]], "value STRING")
    good, bad = split_by_validity(df)
    assert good.count() == sum(parses(t) for t in TEXTS)
    assert good.count() + bad.count() == len(TEXTS) + 1


@pytest.mark.parametrize("text,path,want", [
    ('{"a": {"b": "x"}}', "$.a.b", "x"),
    ('{"a": 1}', "$.a", "1"),
    ('{"a": 1.5}', "$.a", "1.5"),
    ('{"a": true}', "$.a", "true"),
    ('{"a": null}', "$.a", None),
    ('{"a": {"b": 1}}', "$.a", None),
    ('{"a": [1]}', "$.a", None),
    ('{"a": "{x"}', "$.a", "{x"),
    ('{"a": "[1]"}', "$.a", "[1]"),
    ('{"a": "{\\"b\\": 1}"}', "$.a", '{"b": 1}'),
    ('{"a": ""}', "$.a", ""),
    ('{"b": 1}', "$.a", None),
    ('{"a": "x"}', "$.a.b", None),
    ('[{"a": 1}]', "$.a", None),
    ('{"a": ', "$.a", None),
    ("{'a': 1}", "$.a", None),
    ("", "$.a", None),
    (None, "$.a", None),
    ('\n{"a": "later"}', "$.a", "later"),
    ('{"a": 12345678901234567890123}', "$.a", "12345678901234567890123"),
])
def test_json_value(spark, text, path, want):
    df = spark.createDataFrame([(text,)], "t STRING")
    assert df.select(json_value(F.col("t"), path)).first()[0] == want


def test_several_paths_at_once(spark):
    df = spark.createDataFrame([('{"a": {"b": 1, "c": "x"}, "d": "y"}',)], "t STRING")
    paths = {"b": "$.a.b", "whole": "$.a", "c": "$.a.c", "d": "$.d"}
    assert df.select(*json_values(F.col("t"), paths).values()).first() == ("1", None, "x", "y")


@pytest.mark.parametrize("path", ["a", "$", "$.a[*]", "$..a", "$.a b"])
def test_other_paths_are_refused(path):
    with pytest.raises(ValueError):
        json_value(F.col("t"), path)


def test_long_text_is_read_whole(spark):
    df = spark.range(1).select(F.concat(F.lit('{"a":"'), F.repeat(F.lit("x"), 25_000_000), F.lit('"}')).alias("t"))
    assert df.select(is_json(F.col("t")), F.length(json_value(F.col("t"), "$.a"))).first() == (True, 25_000_000)


def test_long_text_with_odd_tokens(spark):
    # Not JSON by the strict rules, so the strings are taken out by pattern.
    df = spark.range(1).select(
        F.concat(F.lit('{"a":NaN,"b":"'), F.repeat(F.lit('x\\\\\\"INF'), 200_000), F.lit('","c":-Infinity}')).alias("t")
    )
    assert df.select(is_json(F.col("t"))).first()[0] is parses(df.first().t) is True


def test_nested_event(spark):
    df = spark.createDataFrame([(ORDER_EVENT,)], "message STRING")
    e = json_parse(F.col("message"), ORDER_SCHEMA)
    got = df.select(e["order"]["placed"], e["order"]["total"]["value"], e["rate"], e["gift"], e["notes"], e["lines"]).first()
    assert tuple(got) == ("2023-05-01T12:00:59", 1995, 0.25, True, {}, [1, 2])
    placed = json_value(F.col("message"), "$.order.placed")
    counted = tumbling_count(df.select(parse_iso_seconds(placed).alias("ts")), [], "ts", "1 minute")
    assert rows(counted) == [(1682942400000, 1682942460000, 1)]
    assert df.select(json_value(F.col("message"), "$.order.total")).first()[0] is None


@pytest.mark.parametrize("text,want", [
    ('{"a":{"b":"x"}}', "x"), ('{"a":{"b":1}}', "1"), ('{"a":{"b":1.5}}', "1.5"), ('{"a":{"b":true}}', "true"),
    ('{"a":{"b":null}}', None), ('{"a":{"b":{}}}', None), ('{"a":{"b":[1]}}', None), ('{"a":{"b":"{x"}}', "{x"),
    ('{"a":1}', None), ('{"b":1}', None), ('{"a":', None), ("", None), (None, None),
    ('{"a":{"b":12345678901234567890123}}', "12345678901234567890123"),
])
def test_json_value_in_sql(spark, text, want):
    register_json_value(spark)
    df = spark.createDataFrame([(text,)], "t STRING")
    assert spark.sql("SELECT json_value(t, '$.a.b') AS v FROM {df}", df=df).first()[0] == want


def test_iso_times(spark):
    df = spark.createDataFrame([("2024-02-19T08:00:07",), ("soon",)], "t STRING")
    lenient = df.select(F.unix_millis(parse_iso_seconds(F.col("t"), strict=False)))
    assert rows(lenient) == [(1708329607000,), (None,)]
    with pytest.raises(Exception):
        df.select(parse_iso_seconds(F.col("t"))).collect()
    back = df.limit(1).select(F.unix_millis(minus_millis(parse_iso_seconds(F.col("t")), 5000)))
    assert rows(back) == [(1708329602000,)]


def test_change_events(spark):
    good = [change("u", OLD, NEW), change("c", None, NEW), change("d", OLD, None), change("u", OLD, OLD)]
    bad = ["{bad", '{"op":"u"}', "[1]", change("u", None, None), '{"after":{"id":1}}']
    df = spark.createDataFrame([(e,) for e in [*good, *bad, None]], "value STRING")
    out = cdc_unpack(df).collect()
    assert [(r.op, r.id, r.table_name, r.ts_ms) for r in out] == [(op, 52, "members", 1700000000123) for op in "ucdu"]
    assert [r.changed for r in out] == [["last_name", "email"], ["id", "first_name", "last_name"], list(OLD), []]
    assert (out[0].before_email, out[0].after_email) == (OLD["email"], None)
    assert out[1].before_id is None and out[2].after_id is None
    # A tombstone is neither a change nor a bad event.
    assert rows(cdc_dead_letters(df)) == sorted([(b,) for b in bad], key=str)


def test_json_rows_both_ways(spark):
    df = spark.createDataFrame([(1, "hi"), (2, None), (None, "")], "f0 INT, f1 STRING")
    values = as_json_value(df)
    assert rows(values) == sorted([('{"f0":1,"f1":"hi"}',), ('{"f0":2,"f1":null}',), ('{"f0":null,"f1":""}',)], key=str)
    assert rows(json_rows(values, "f0 INT, f1 STRING")) == rows(df)


def test_bad_rows_fail_or_go_to_dead_letters(spark):
    good = ['{"f0":1,"f1":"a"}', "{}", ' {"f1":"b","more":2}']
    bad = ["{'f0':1}", '{"f0":"x"}', '[{"f0":1}]', "", "7", '{"f0":', None]
    df = spark.createDataFrame([(t,) for t in [*good, *bad]], "value STRING")
    schema = "f0 INT, f1 STRING"
    assert rows(json_rows(df, schema, bad="drop")) == sorted([(1, "a"), (None, None), (None, "b")], key=str)
    assert rows(bad_events(df, schema)) == sorted([(b,) for b in bad], key=str)
    for text in bad:
        with pytest.raises(Exception, match="not an event"):
            json_rows(spark.createDataFrame([(text,)], "value STRING"), schema).collect()
    with pytest.raises(ValueError):
        json_rows(df, schema, bad="ignore")
