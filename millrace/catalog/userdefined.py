"""The surface for functions users write in Python."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.catalog.batch import DAY_COUNTS, K, TOP2
from millrace.catalog.inputs import events, events_with_k, profiles
from millrace.catalog.registry import registered
from millrace.functions.jsons import json_value
from millrace.functions.scalars import parse_iso_seconds
from millrace.operators import joins
from millrace.operators.aggregates import top_of_changes
from millrace.operators.changelog import changelog_aggregate
from millrace.operators.userdefined import CountSum, Largest, WindowCount, aggregate, window_process
from millrace.operators.userfunctions import map_rows, register_function
from millrace.plans.inspect import sql_query


def doubled_score(row: dict) -> tuple:
    score = json.loads(row["data"]).get("score")
    return row["id"], None if score is None else 2 * score


def user_and_kind(key: int, data: str):
    """A row for the user, and one for the kind of every third event."""
    event = json.loads(data)
    yield key, event["seen"]["user"]
    if key % 3 == 0:
        yield key, event["kind"]


def flat_event(data: str):
    event = json.loads(data)
    return [(event["kind"], event.get("score"), event["seen"]["user"])]


def letters(text: str):
    """Each letter with how often the text has it."""
    return sorted((c, text.count(c)) for c in set(text))


@registered("udf_row_map", f"SELECT event_id AS id, 2 * CAST({K} AS BIGINT) AS doubled FROM events")
def _(spark, d):
    return map_rows(profiles(spark, d), doubled_score, ["id", "data"], "id BIGINT, doubled BIGINT")


@registered("udtf_flat_map", """
    SELECT event_id AS f0, user_id::VARCHAR AS f1 FROM events
    UNION ALL SELECT event_id, event_type FROM events WHERE event_id % 3 = 0""")
def _(spark, d):
    both = joins.table_function(user_and_kind, "id BIGINT, value STRING")
    return joins.flat_map(profiles(spark, d), both, "id", "data")


@registered("lateral_python_udtf", """
    SELECT event_id, event_type, a, CAST(length(event_type) - length(replace(event_type, a, '')) AS INTEGER) AS n
    FROM (SELECT event_id, event_type, unnest(list_distinct(string_split(event_type, ''))) AS a FROM events)""")
def _(spark, d):
    counted = joins.table_function(letters, "a STRING, n INT")
    return joins.join_lateral(events(spark, d).select("event_id", "event_type"), counted, "event_type")


@registered("register_udtf_sql", f"""
    SELECT event_id AS id, event_type AS kind, CAST({K} AS INTEGER) AS score, user_id::VARCHAR AS member FROM events""")
def _(spark, d):
    joins.register_table_function(spark, "flat_event", flat_event, "kind STRING, score INT, member STRING")
    return sql_query(
        spark,
        "SELECT e.id, t.kind, t.score, t.member FROM {events} AS e, LATERAL flat_event(e.data) AS t(kind, score, member)",
        events=profiles(spark, d),
    )


@registered("register_udf_sql", "SELECT event_id, epoch_us(ts) // 1000 - 5000 AS watermark_ms FROM events")
def _(spark, d):
    register_function(spark, "five_seconds_before", lambda ms: ms - 5000, "BIGINT")
    return sql_query(
        spark,
        "SELECT event_id, five_seconds_before(unix_millis(ts)) AS watermark_ms FROM {events}",
        events=events(spark, d),
    )


@registered("udaf_surface", f"""
    SELECT user_id, count(*) AS cnt, CAST(sum({K}) AS BIGINT) AS "sum" FROM events GROUP BY user_id""")
def _(spark, d):
    return aggregate(events_with_k(spark, d), ["user_id"], CountSum("k"), ["k"])


@registered("udaf_retract", """
    SELECT event_type, CAST(1 AS BIGINT) AS cnt, count(*) AS "sum" FROM events GROUP BY event_type""")
def _(spark, d):
    # The count's own change log: all but the last value are taken back.
    log = changelog_aggregate(events(spark, d), ["event_type"], "event_id", {"seen": ("count", "event_id")})
    return aggregate(log, ["event_type"], CountSum("seen"), ["seen"], op="op")


TOP2_OF_SUMS = f"""
    SELECT event_type, "sum" FROM (
        SELECT event_type, "sum", row_number() OVER (PARTITION BY event_type ORDER BY "sum" DESC) AS r
        FROM (SELECT event_type, user_id, CAST(sum({K}) AS BIGINT) AS "sum" FROM events GROUP BY event_type, user_id)
    ) WHERE r <= 2 AND "sum" <> 0"""


@registered("udtaf_retract", TOP2_OF_SUMS)
def _(spark, d):
    # Each user's running sum takes its last value back, so most of what was once largest is gone in the end.
    log = changelog_aggregate(events_with_k(spark, d), ["event_type", "user_id"], "event_id", {"sum": ("sum", "k")})
    return top_of_changes(log, ["event_type"], "sum")


@registered("udtaf_surface", TOP2)
def _(spark, d):
    return aggregate(events_with_k(spark, d), ["event_type"], Largest("k"), ["k"])


@registered("window_process_fn", DAY_COUNTS)
def _(spark, d):
    return window_process(events(spark, d), ["event_type"], "ts", "1 day", WindowCount(), [])


def created_at(data: Column) -> Column:
    return parse_iso_seconds(json_value(data, "$.seen.at"))


@registered("timestamp_assigner_fn", """
    SELECT event_id AS id, epoch_ms(date_trunc('second', ts)) AS event_ms FROM events""")
def _(spark, d):
    return profiles(spark, d).select("id", F.unix_millis(created_at(F.col("data"))).alias("event_ms"))
