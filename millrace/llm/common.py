"""Expressions and scratch tables shared by the text operators."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_dir

#: A word: a longest run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows a table may have for it to be broadcast by hand: a few MB of keys and numbers.
BROADCAST_ROWS = 200_000

MOST_BUCKETS = 50_000

SPANS = "array<struct<start:int,end:int,hit:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def stash(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage, and gives the planner true sizes."""
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stash_by(df: DataFrame, key: str, least: int, label: str) -> DataFrame:
    """Like ``stash``, in buckets by ``key``, so that later joins and groupings by it need not shuffle these rows.

    At least ``least`` buckets, and no fewer than there are shuffle partitions,
    below which Spark would rather shuffle again.
    """
    spark = df.sparkSession
    buckets = min(MOST_BUCKETS, max(least, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    name = f"{label}_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, key).option("path", scratch_dir(spark, label)).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay; only the name goes
    return out


def literal(value: object, kind: str) -> Column:
    """A constant too large to be built element by element; folded to a literal when the query is planned."""
    return F.from_json(F.lit(json.dumps(value, separators=(",", ":"))), kind)


def small_or_not(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark for broadcast if a count shows that it has at most ``rows`` rows; else leave the join to shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def spans_of(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches, as structs of start, end (code points, exclusive) and the matched text.

    What lies between the matches is what ``split`` returns, so lengths of
    gaps and matches in turn add up to the positions.
    """
    def place(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + F.char_length(pair["gap"])
        end = begin + F.char_length(pair["hit"])
        one = F.struct(begin.alias("start"), end.alias("end"), pair["hit"].alias("hit"))
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(one)).alias("found"))

    def located(hits: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("found"))
        return F.aggregate(F.arrays_zip(gaps.alias("gap"), hits.alias("hit")), start, place)["found"]

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
               lambda hits: F.when(F.size(hits) > 0, located(hits)).otherwise(F.array().cast(SPANS)))


def of_kind(spans: Column, kind: str, rank: int, score: Column | Callable[[Column], Column]) -> Column:
    """Spans as structs that carry their kind, the kind's place in the listing and a score."""
    def one(s: Column) -> Column:
        value = score(s) if callable(score) else score
        return F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"),
                        F.lit(kind).alias("kind"), value.cast("double").alias("score"), s["hit"].alias("hit"))

    return F.transform(spans, one)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def counts_of(spans: str, kinds: tuple[str, ...]) -> list[Column]:
    """One ``n_<kind>`` column for each kind."""
    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return [count(k) for k in kinds]
