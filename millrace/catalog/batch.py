"""Projections, filters, joins, aggregates, scalars, windows in batch, plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.inputs import ROW, change_events, events, events_with_k, k, mixed_strings, profiles
from millrace.catalog.registry import registered
from millrace.functions.jsons import json_parse, json_value, json_values, register_json_value
from millrace.functions.scalars import (
    concat,
    equal,
    event_time_from_millis,
    minus_millis,
    not_equal,
    parse_iso_seconds,
    split_text,
    to_bigint,
    to_text,
    to_timestamp,
)
from millrace.operators import columns, joins, rows
from millrace.operators.aggregates import group_count_max, group_count_sum, top_per_group
from millrace.operators.cdc import cdc_unpack
from millrace.operators.changelog import changelog_aggregate
from millrace.operators.running import running_aggregates
from millrace.operators.timers import keyed_sum_at_timers
from millrace.operators.windows import tumbling_count
from millrace.plans.inspect import explain_sql, schema_lines, sql_query
from millrace.sources.memory import from_collection, from_elements
from millrace.sources.tables import load_table

K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S')"
DAY_COUNTS = """
    SELECT event_type, epoch_ms(date_trunc('day', ts)) AS window_start,
           epoch_ms(date_trunc('day', ts) + INTERVAL 1 DAY) AS window_end, count(*) AS cnt
    FROM events GROUP BY event_type, date_trunc('day', ts)"""
MINUTE_COUNTS = """
    SELECT epoch_ms(date_trunc('minute', ts)) AS window_start,
           epoch_ms(date_trunc('minute', ts) + INTERVAL 1 MINUTE) AS window_end, count(*) AS event_count
    FROM events GROUP BY date_trunc('minute', ts)"""
TOP2 = f"""
    SELECT event_type, k FROM (
        SELECT event_type, k, row_number() OVER (PARTITION BY event_type ORDER BY k DESC) AS r
        FROM (SELECT event_type, {K} AS k FROM events)
    ) WHERE r <= 2 AND k <> 0"""

# --- in-memory tables, joined to a stored one ---------------------------------------------

KINDS = [("click", 1), ("view", 1), ("purchase", 3), ("signup", 2), ("error", 0)]


@registered("from_elements", """
    SELECT v.weight, count(*) AS cnt
    FROM events e JOIN (VALUES ('click', 1), ('view', 1), ('purchase', 3), ('signup', 2), ('error', 0))
        AS v(kind, weight) ON e.event_type = v.kind
    GROUP BY v.weight""")
def _(spark, d):
    kinds = from_elements(spark, KINDS, ["kind", "weight"])
    joined = joins.join_inner(events(spark, d), kinds, [("event_type", "kind")])
    return joined.groupBy("weight").agg(F.count("*").alias("cnt"))


@registered("from_collection", """
    SELECT v.kind, v.weight, count(*) AS cnt
    FROM events e JOIN (VALUES ('click', 1), ('view', 1), ('purchase', 3), ('signup', 2), ('error', 0))
        AS v(kind, weight) ON e.event_type = v.kind
    GROUP BY v.kind, v.weight""")
def _(spark, d):
    kinds = from_collection(spark, KINDS, "kind STRING, weight INT")
    joined = joins.join_inner(events(spark, d), kinds, [("event_type", "kind")])
    return joined.groupBy("kind", "weight").agg(F.count("*").alias("cnt"))


# --- projections, filters, limits ---------------------------------------------------------


@registered("select_columns", "SELECT event_id, event_type, value FROM events")
def _(spark, d):
    return columns.select_columns(events(spark, d), "event_id", "event_type", F.col("value"))


@registered("add_columns", f"""
    SELECT event_id AS id, event_type AS kind, CAST({K} AS VARCHAR) AS score, user_id::VARCHAR AS member FROM events""")
def _(spark, d):
    paths = {"kind": "$.kind", "score": "$.score", "member": "$.seen.user"}
    df = columns.add_columns(profiles(spark, d), json_values(F.col("data"), paths))
    return columns.drop_columns(df, "data")


@registered("drop_columns", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def _(spark, d):
    return columns.drop_columns(load_table(spark, d, "orders"), "o_orderdate", "o_orderpriority")


@registered("rename_columns", """
    SELECT c_custkey AS id, c_name, c_nationkey, c_acctbal AS balance, c_mktsegment FROM customer""")
def _(spark, d):
    return columns.rename_columns(load_table(spark, d, "customer"), {"c_custkey": "id", "c_acctbal": "balance"})


@registered("add_or_replace_columns", """
    SELECT CAST(c_custkey AS VARCHAR) || '_' || c_name AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
    FROM customer""")
def _(spark, d):
    replaced = concat(to_text(F.col("c_custkey")), F.lit("_"), F.col("c_name"))
    return columns.add_or_replace_columns(load_table(spark, d, "customer"), {"c_custkey": replaced})


@registered("alias", "SELECT l_orderkey AS key, l_quantity * l_extendedprice AS gross FROM lineitem")
def _(spark, d):
    gross = (F.col("l_quantity") * F.col("l_extendedprice")).alias("gross")
    return load_table(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), gross)


@registered("filter_ne", "SELECT event_id, user_id, event_type, value FROM events WHERE event_type <> 'error'")
def _(spark, d):
    return rows.filter_not_equal(events(spark, d), "event_type", "error").select(
        "event_id", "user_id", "event_type", "value"
    )


@registered("json_validity_split", """
    SELECT event_id, CASE WHEN event_type = 'error' THEN left(props, length(props) - 1) ELSE props END AS value,
           event_type <> 'error' AS valid
    FROM events""")
def _(spark, d):
    return rows.with_validity(mixed_strings(spark, d))


@registered("json_validity_texts", """
    SELECT 'documents' AS origin, json_valid(text) AS valid, count(*) AS cnt FROM documents GROUP BY ALL
    UNION ALL SELECT 'pages', json_valid(html), count(*) FROM pages GROUP BY ALL
    UNION ALL SELECT 'props', json_valid(props), count(*) FROM events GROUP BY ALL""")
def _(spark, d):
    def texts(table: str, column: str, origin: str):
        return load_table(spark, d, table).select(F.lit(origin).alias("origin"), F.col(column).alias("value"))

    everything = (
        texts("documents", "text", "documents")
        .unionByName(texts("pages", "html", "pages"))
        .unionByName(texts("events", "props", "props"))
    )
    return rows.with_validity(everything).groupBy("origin", "valid").agg(F.count("*").alias("cnt"))


@registered("limit", "SELECT event_id, event_type, value FROM events ORDER BY event_id LIMIT 3")
def _(spark, d):
    return rows.limit_rows(events(spark, d).select("event_id", "event_type", "value"), 3, "event_id")


# --- joins --------------------------------------------------------------------------------


@registered("join_inner_equi", """
    SELECT o_orderkey, o_custkey, o_totalprice, c_custkey, c_name, c_nationkey
    FROM orders JOIN customer ON o_custkey = c_custkey""")
def _(spark, d):
    orders = load_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = load_table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    return joins.join_inner(orders, customers, [("o_custkey", "c_custkey")])


@registered("join_rename_right", """
    SELECT c.c_custkey, c.c_name, c.c_nationkey, n.n_nationkey AS r_nationkey, n.n_name
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def _(spark, d):
    right = columns.rename_columns(load_table(spark, d, "nation"), {"n_nationkey": "r_nationkey"})
    joined = joins.join_inner(load_table(spark, d, "customer"), right, [("c_nationkey", "r_nationkey")])
    return joined.select("c_custkey", "c_name", "c_nationkey", "r_nationkey", "n_name")


@registered("join_lateral_udtf", """
    SELECT event_id, event_type, unnest(string_split(event_type, 'i')) AS a FROM events""")
def _(spark, d):
    df = events(spark, d).select("event_id", "event_type")
    return joins.lateral_split(df, "event_type", "i", "a")


@registered("sql_lateral_table", f"""
    SELECT event_id AS id, event_type AS kind, CAST({K} AS INTEGER) AS score, user_id::VARCHAR AS member FROM events""")
def _(spark, d):
    return sql_query(
        spark,
        """
        SELECT id, t.kind, t.score, t.member
        FROM {events}, LATERAL (SELECT j.kind, j.score, j.seen.user AS member FROM (
            SELECT from_json(data, 'kind STRING, score INT, seen STRUCT<user: STRING>') AS j)) AS t
        """,
        events=profiles(spark, d),
    )


# --- aggregates ---------------------------------------------------------------------------


@registered("group_count_max", f"""
    SELECT event_type, count(event_id) AS cnt, max({K}) AS max_k FROM events GROUP BY event_type""")
def _(spark, d):
    lenient = to_bigint(json_value(F.col("props"), "$.k"), strict=False)
    return group_count_max(events(spark, d), ["event_type"], "event_id", lenient, "cnt", "max_k")


@registered("distinct", "SELECT DISTINCT c_mktsegment FROM customer")
def _(spark, d):
    return rows.distinct_rows(load_table(spark, d, "customer"), "c_mktsegment")


@registered("udaf_count_sum", f"""
    SELECT user_id, count(*) AS cnt, CAST(sum({K}) AS BIGINT) AS "sum" FROM events GROUP BY user_id""")
def _(spark, d):
    return group_count_sum(events(spark, d), ["user_id"], k())


@registered("udtaf_top2", TOP2)
def _(spark, d):
    return top_per_group(events_with_k(spark, d), ["event_type"], "k")


@registered("window_count", """
    SELECT epoch_ms(date_trunc('hour', ts)) AS window_start,
           epoch_ms(date_trunc('hour', ts) + INTERVAL 1 HOUR) AS window_end, count(*) AS cnt
    FROM events GROUP BY date_trunc('hour', ts)""")
def _(spark, d):
    return tumbling_count(events(spark, d), [], "ts", "1 hour")


@registered("running_sum", """
    SELECT user_id, event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY event_id), 2) AS running
    FROM events""")
def _(spark, d):
    df = events(spark, d).select("user_id", "event_id", "value")
    summed = running_aggregates(df, ["user_id"], ["event_id"], {"running": ("sum", "value")})
    return summed.select("user_id", "event_id", F.round("running", 2).alias("running"))


# --- scalars ------------------------------------------------------------------------------


@registered("json_value", """
    SELECT event_id AS id, user_id::VARCHAR AS member, NULL::VARCHAR AS seen, NULL::VARCHAR AS missing FROM events""")
def _(spark, d):
    paths = {"member": "$.seen.user", "seen": "$.seen", "missing": "$.seen.place"}
    return profiles(spark, d).select("id", *[c.alias(n) for n, c in json_values(F.col("data"), paths).items()])


@registered("json_value_sql", """
    SELECT event_id, CASE WHEN event_id % 4 = 0 THEN event_type WHEN event_id % 4 = 1 THEN user_id::VARCHAR END AS got
    FROM events""")
def _(spark, d):
    # Text, a number, an object and text that is not JSON at the same path.
    register_json_value(spark)
    return sql_query(spark, """
        SELECT event_id, json_value(CASE event_id % 4
            WHEN 0 THEN to_json(named_struct('a', named_struct('b', event_type)))
            WHEN 1 THEN to_json(named_struct('a', named_struct('b', user_id)))
            WHEN 2 THEN to_json(named_struct('a', named_struct('b', array(event_type))))
            ELSE '{{"a": {{"b": ' END, '$.a.b') AS got
        FROM {events}""", events=events(spark, d))


@registered("cast_types", f"""
    SELECT event_id, {K} AS k, CAST(event_id AS VARCHAR) AS id_text, epoch_us(CAST({ISO} AS TIMESTAMP)) AS micros
    FROM events""")
def _(spark, d):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return events(spark, d).select(
        "event_id",
        k().alias("k"),
        to_text(F.col("event_id")).alias("id_text"),
        F.unix_micros(to_timestamp(text)).alias("micros"),
    )


@registered("concat", "SELECT n_nationkey, CAST(n_nationkey AS VARCHAR) || '_' || n_name AS tagged FROM nation")
def _(spark, d):
    tagged = concat(to_text(F.col("n_nationkey")), F.lit("_"), F.col("n_name"))
    return load_table(spark, d, "nation").select("n_nationkey", tagged.alias("tagged"))


@registered("parse_iso_ts", "SELECT event_id AS id, epoch_ms(date_trunc('second', ts)) AS millis FROM events")
def _(spark, d):
    utc = json_value(F.col("data"), "$.seen.at")
    return profiles(spark, d).select("id", F.unix_millis(parse_iso_seconds(utc)).alias("millis"))


@registered("json_parse", f"""
    SELECT event_id AS id, event_type AS kind, {K} AS score, user_id::VARCHAR AS member FROM events""")
def _(spark, d):
    parsed = json_parse(F.col("data"), "kind STRING, score BIGINT, seen STRUCT<user: STRING, at: STRING>")
    return profiles(spark, d).select("id", parsed.alias("j")).select(
        "id", "j.kind", "j.score", F.col("j.seen.user").alias("member"))


@registered("str_split", """
    SELECT doc_id, len(string_split(text, '. ')) AS pieces, string_split(text, '. ')[1] AS first FROM documents""")
def _(spark, d):
    pieces = split_text(F.col("text"), ". ")
    return load_table(spark, d, "documents").select(
        "doc_id", F.size(pieces).cast("bigint").alias("pieces"), pieces.getItem(0).alias("first")
    )


@registered("ts_minus", "SELECT event_id, epoch_us(ts) - 5000000 AS micros FROM events")
def _(spark, d):
    return events(spark, d).select("event_id", F.unix_micros(minus_millis(F.col("ts"), 5000)).alias("micros"))


@registered("str_to_int", f"SELECT event_id, {K} AS k FROM events")
def _(spark, d):
    return events(spark, d).select("event_id", k().alias("k"))


@registered("not_equal", """
    SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'""")
def _(spark, d):
    df = load_table(spark, d, "orders")
    return rows.filter_rows(df, not_equal(F.col("o_orderstatus"), F.lit("F"))).select("o_orderkey", "o_orderstatus")


@registered("equal", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def _(spark, d):
    df = load_table(spark, d, "orders")
    return rows.filter_rows(df, equal(F.col("o_orderstatus"), F.lit("F"))).select("o_orderkey", "o_orderstatus")


# --- event time in batch ------------------------------------------------------------------


@registered("assign_event_time", """
    SELECT event_id, epoch_ms(date_trunc('second', ts)) AS from_text, epoch_us(ts) // 1000 AS from_millis,
           epoch_ms(date_trunc('second', ts)) AS from_json
    FROM events""")
def _(spark, d):
    millis = events(spark, d).select(
        "event_id", F.unix_millis("ts").alias("order"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("text")
    )
    wrapped = F.to_json(F.struct(F.struct(F.col("text").alias("utc")).alias("created")))
    return millis.select(
        "event_id",
        F.unix_millis(parse_iso_seconds(F.col("text"))).alias("from_text"),
        F.unix_millis(event_time_from_millis(F.col("order"))).alias("from_millis"),
        F.unix_millis(parse_iso_seconds(json_value(wrapped, "$.created.utc"))).alias("from_json"),
    )


@registered("tumbling_event_window", DAY_COUNTS)
def _(spark, d):
    return tumbling_count(events(spark, d), ["event_type"], "ts", "1 day")


@registered("sql_tumble", MINUTE_COUNTS)
def _(spark, d):
    register_json_value(spark)
    return sql_query(
        spark,
        """
        SELECT unix_millis(window.start) AS window_start, unix_millis(window.end) AS window_end,
               count(*) AS event_count
        FROM (SELECT try_cast(json_value(data, '$.seen.at') AS TIMESTAMP) AS utc FROM {events})
        GROUP BY window(utc, '1 minute')
        """,
        events=profiles(spark, d),
    )


@registered("key_by", "SELECT user_id, count(*) AS cnt, max(event_id) AS last_id FROM events GROUP BY user_id")
def _(spark, d):
    return group_count_max(events(spark, d), ["user_id"], "event_id", F.col("event_id"), "cnt", "last_id")


@registered("keyed_sum_timers", """
    SELECT DISTINCT user_id, epoch_us(ts + INTERVAL 2 SECONDS) AS timer,
        round(sum(value) OVER (PARTITION BY user_id ORDER BY ts
              RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 2 SECONDS FOLLOWING), 2) AS "sum"
    FROM events""")
def _(spark, d):
    sums = keyed_sum_at_timers(events(spark, d), ["user_id"], "ts", "value")
    return sums.select("user_id", F.unix_micros("timer").alias("timer"), F.round("sum", 2).alias("sum"))


@registered("changelog_agg", f"""
    WITH r AS (
        SELECT event_type, event_id, count(*) OVER w AS cnt, max({K}) OVER w AS max_k
        FROM events WINDOW w AS (PARTITION BY event_type ORDER BY event_id)),
    l AS (
        SELECT *, lag(cnt) OVER w AS old_cnt, lag(max_k) OVER w AS old_max
        FROM r WINDOW w AS (PARTITION BY event_type ORDER BY event_id))
    SELECT event_type, event_id, '+I' AS op, cnt, max_k FROM l WHERE old_cnt IS NULL
    UNION ALL SELECT event_type, event_id, '-U', old_cnt, old_max FROM l WHERE old_cnt IS NOT NULL
    UNION ALL SELECT event_type, event_id, '+U', cnt, max_k FROM l WHERE old_cnt IS NOT NULL""")
def _(spark, d):
    return changelog_aggregate(
        events_with_k(spark, d), ["event_type"], "event_id", {"cnt": ("count", "event_id"), "max_k": ("max", "k")}
    )


# --- change data, schema, plans -----------------------------------------------------------


CDC = """
    SELECT op, 'customers' AS table_name, '0001' AS commit_lsn, c_custkey * 1000 AS ts_ms, c_custkey AS id,
           CASE WHEN op <> 'c' THEN c_acctbal END AS before_balance,
           CASE WHEN op <> 'd' THEN -c_acctbal END AS after_balance,
           CASE WHEN op <> 'd' THEN c_name END AS after_name,
           CASE WHEN op = 'u' THEN CASE WHEN c_acctbal = 0 THEN '' ELSE 'balance' END
                ELSE 'id,name,segment,balance' END AS changed
    FROM (SELECT *, CASE c_mktsegment WHEN 'BUILDING' THEN 'c' WHEN 'MACHINERY' THEN 'd' ELSE 'u' END AS op
          FROM customer)"""


def unpacked_changes(strings):
    return cdc_unpack(strings, row_schema=ROW).select(
        "op", "table_name", "commit_lsn", "ts_ms", "id", "before_balance", "after_balance", "after_name",
        F.array_join("changed", ",").alias("changed"),
    )


@registered("cdc_unpack", CDC)
def _(spark, d):
    return unpacked_changes(change_events(spark, d))


@registered("print_schema", """
    SELECT '`event_id` BIGINT' AS line, count(event_id) AS filled FROM events
    UNION ALL SELECT '`ts` TIMESTAMP', count(ts) FROM events
    UNION ALL SELECT '`user_id` BIGINT', count(user_id) FROM events
    UNION ALL SELECT '`event_type` STRING', count(event_type) FROM events
    UNION ALL SELECT '`value` DOUBLE', count(value) FROM events
    UNION ALL SELECT '`props` STRING', count(props) FROM events""")
def _(spark, d):
    # The schema lines, each with the number of rows that fill the column.
    df = events(spark, d)
    filled = df.agg(*[F.count(c).alias(c) for c in df.columns])
    lines = zip(df.columns, schema_lines(df))
    pairs = [F.struct(F.lit(line).alias("line"), F.col(c).alias("filled")) for c, line in lines]
    return filled.select(F.inline(F.array(*pairs)))


@registered("explain", """
    SELECT event_type, count(*) AS cnt, true AS aggregates_twice FROM events GROUP BY event_type""")
def _(spark, d):
    # The query itself, with what its plan says: combined before the shuffle and after.
    statement = "SELECT event_type, count(*) AS cnt FROM {e} GROUP BY event_type"
    plan = explain_sql(spark, statement, e=events(spark, d))
    twice = plan[plan.index("Physical Plan"):].count("HashAggregate") == 2
    return sql_query(spark, statement, e=events(spark, d)).withColumn("aggregates_twice", F.lit(twice))


@registered("sql_query", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'")
def _(spark, d):
    return sql_query(
        spark,
        "SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_orderstatus = 'O'",
        orders=load_table(spark, d, "orders"),
    )
