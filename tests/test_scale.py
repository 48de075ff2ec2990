"""Operators against brute force, with one key holding much of the data."""

import random
import re
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from fixtures import rows
from millrace.functions.jsons import json_value, json_values
from millrace.operators import userdefined
from millrace.operators.aggregates import top_per_group
from millrace.operators.changelog import changelog_aggregate
from millrace.operators.joins import join_inner
from millrace.operators.running import running_aggregates
from millrace.operators.timers import keyed_sum_at_timers
from millrace.operators.userdefined import CountSum, Largest, aggregate
from millrace.plans.inspect import explain
from millrace.sources.tables import load_table

SF = "/root/testdata/sf0.001"


def skewed(n=900, seed=7):
    rng = random.Random(seed)
    return [
        ("hot" if rng.random() < 0.4 else rng.choice([None, "a", "b", "c"]), i, rng.choice([None, *range(-9, 10)]))
        for i in range(n)
    ]


@pytest.mark.parametrize("chunks,plain", [(11, False), (None, False), (None, True)])
def test_running_aggregates(spark, chunks, plain):
    data = skewed()
    df = spark.createDataFrame(data, "k STRING, i BIGINT, v BIGINT").repartition(5)
    aggs = {"total": ("sum", "v"), "n": ("count", "v"), "top": ("max", "v"), "low": ("min", "v")}
    out = running_aggregates(df, ["k"], ["i"], aggs, {"before": "total"}, chunks=chunks, plain=plain)
    assert ("__chunk" in explain(out)) == (not plain)
    want, seen = [], defaultdict(list)
    for k, i, v in data:
        earlier = [x for x in seen[k] if x is not None]
        seen[k].append(v)
        upto = [x for x in seen[k] if x is not None]
        want.append((k, i, v, sum(upto) if upto else None, len(upto), max(upto, default=None),
                     min(upto, default=None), sum(earlier) if earlier else None))
    assert rows(out) == sorted(want, key=str)


def test_a_hot_key_is_cut_evenly(spark):
    df = spark.createDataFrame(skewed(), "k STRING, i BIGINT, v BIGINT").repartition(5)
    cut = df.repartitionByRange(11, "k", "i").groupBy(F.spark_partition_id()).count()
    assert cut.count() == 11 and cut.agg(F.max("count")).first()[0] < 2 * 900 / 11


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 9), st.integers(-5, 5)), min_size=1, max_size=40),
       st.integers(1, 6))
def test_sums_at_timers(spark, data, chunks):
    df = spark.createDataFrame(data, "k STRING, s BIGINT, v BIGINT")
    df = df.select("k", F.timestamp_seconds("s").alias("t"), "v")
    out = keyed_sum_at_timers(df, ["k"], "t", "v", chunks=chunks)
    got = rows(out.select("k", F.unix_seconds("timer"), "sum"))
    want = {(k, s + 2, sum(v for k2, s2, v in data if k2 == k and s2 <= s + 2)) for k, s, _ in data}
    assert got == sorted(want, key=str)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 3)), min_size=1, max_size=30), st.integers(1, 6))
def test_changelog_adds_up(spark, data, chunks):
    df = spark.createDataFrame([(k, i, v) for i, (k, v) in enumerate(data)], "k STRING, i BIGINT, v BIGINT")
    log = changelog_aggregate(df, ["k"], "i", {"n": ("count", "v"), "top": ("max", "v")}, chunks=chunks).collect()
    state, want = {}, []
    for i, (k, v) in enumerate(data):
        old = state.get(k)
        new = (1, v) if old is None else (old[0] + 1, max(old[1], v))
        want += [(k, i, "+I", *new)] if old is None else [(k, i, "-U", *old), (k, i, "+U", *new)]
        state[k] = new
    assert sorted(map(tuple, log)) == sorted(want)


def test_user_aggregates_flush_and_merge(spark, monkeypatch):
    monkeypatch.setattr(userdefined, "KEYS_IN_MEMORY", 2)
    monkeypatch.setattr(userdefined, "ROWS_PER_BATCH", 3)
    data = [(k, v) for k, _, v in skewed() if v is not None]
    df = spark.createDataFrame(data, "k STRING, v BIGINT").repartition(6)
    by_key = defaultdict(list)
    for k, v in data:
        by_key[k].append(v)
    assert rows(aggregate(df, ["k"], CountSum("v"), ["v"])) == sorted(
        ((k, len(vs), sum(vs)) for k, vs in by_key.items()), key=str)
    top = sorted(((k, v) for k, vs in by_key.items() for v in sorted(vs, reverse=True)[:3] if v), key=str)
    assert rows(aggregate(df, ["k"], Largest("v", 3), ["v"])) == top
    assert rows(top_per_group(df, ["k"], "v", 3)) == top


def test_user_aggregate_keeps_wide_integers(spark):
    big = 2**62 + 1
    df = spark.createDataFrame([(big, 1), (None, 2), (big, 3)], "k BIGINT, v BIGINT")
    assert rows(aggregate(df, ["k"], CountSum("v"), ["v"])) == sorted([(big, 2, 4), (None, 1, 2)], key=str)


def test_user_aggregate_retracts(spark):
    log = [("a", "+I", 5), ("a", "-U", 5), ("a", "+U", 8), ("b", "+I", 1), ("b", "-D", 1)]
    df = spark.createDataFrame(log, "k STRING, op STRING, v BIGINT").repartition(3)
    assert rows(aggregate(df, ["k"], CountSum("v"), ["v"], op="op")) == [("a", 1, 8), ("b", 0, 0)]


@pytest.mark.parametrize("kind", ["DOUBLE", "STRUCT<a: DOUBLE, b: STRING>", "ARRAY<DOUBLE>"])
def test_user_aggregate_keys_are_those_of_grouping(spark, kind):
    numbers = [float("nan"), 0.0, -0.0, 1.5, None, float("nan"), 1.5, -0.0]
    wrap = {"D": lambda x: x, "S": lambda x: (x, "s"), "A": lambda x: [x, 2.0]}[kind[0]]
    data = [(wrap(x), i) for i, x in enumerate(numbers)] + [(None, 100), (None, 200)]
    df = spark.createDataFrame(data, f"k {kind}, v BIGINT").repartition(4)
    want = df.groupBy("k").agg(F.count("v").alias("n"), F.sum("v").alias("s"))
    # As text, in which NaN equals itself.
    assert str(rows(aggregate(df, ["k"], CountSum("v"), ["v"]))) == str(rows(want))


def test_user_aggregate_on_empty_input(spark):
    df = spark.createDataFrame([], "k STRING, v BIGINT")
    assert rows(aggregate(df, ["k"], CountSum("v"), ["v"])) == []


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_splits_a_hot_key(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        left = spark.range(60_000, numPartitions=8).select(
            F.when(F.col("id") < 40_000, 1).otherwise(F.col("id") - 40_000).alias("l"),
            F.sha1(F.col("id").cast("string")).alias("x"),
        )
        right = spark.range(20_000).select(F.col("id").alias("r"))
        joined = join_inner(left, right, [("l", "r")])
        assert "skew=true" in final_plan(joined)
        assert joined.count() == 60_000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_scans_read_what_they_need(spark):
    events = load_table(spark, SF, "events")
    some = events.filter("event_type <> 'error' AND ts > TIMESTAMP '2024-01-02'")
    plan = explain(some.select("event_id"), "formatted")
    assert "Not(EqualTo(event_type,error))" in plan and "GreaterThan(ts," in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp,event_type:string>" in plan
    counted = events.groupBy("event_type").agg(F.max(json_value(F.col("props"), "$.k")))
    assert "ReadSchema: struct<event_type:string,props:string>" in explain(counted, "formatted")


def test_top_n_limits_before_the_shuffle(spark):
    plan = explain(top_per_group(spark.range(9).select((F.col("id") % 2).alias("k"), "id"), ["k"], "id"), "formatted")
    # A final and a partial limit: the partial one sits below the exchange.
    assert plan.count("WindowGroupLimit") >= 2


def test_distinct_and_aggregates_combine_before_the_shuffle(spark):
    events = load_table(spark, SF, "events")
    plan = explain(events.select("event_type").dropDuplicates(), "formatted")
    assert plan.index("Exchange") < plan.rindex("HashAggregate")


def test_several_paths_share_one_parse(spark):
    paths = {"a": "$.k", "b": "$.m.n", "c": "$.m.o"}
    plan = explain(load_table(spark, SF, "events").select(*json_values(F.col("props"), paths).values()))
    shapes = set(re.findall(r"from_json\((StructField.*?), \(mode", plan))
    # One shape with text leaves; the typed ones are for rows that look nested.
    assert len([s for s in shapes if "VariantType" not in s]) == 1
