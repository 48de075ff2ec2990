"""Balanced shards by sampled splitters.

Records are ordered by a hash of their text, so equal texts lie together. A
size-weighted sample of keys gives quantile boundaries; a range that holds more
rows than its share, such as one with a hot text, is cut further by a hash of the id
and the row. Ranges are then counted exactly, and a record goes to the shard in
which its first byte falls when all records are laid end to end. So shards
differ by no more than one record, whatever the sample said.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import stash

OVERHEAD = 8
#: Ranges asked for: one for each RANGE_BYTES, within these limits. They bound the sample too.
LEAST_RANGES, MOST_RANGES, RANGE_BYTES, PER_RANGE = 384, 4096, 256 << 20, 16


def boundaries(sample: pd.DataFrame, ranges: int) -> np.ndarray:
    """Keys that cut the sampled weight into equal parts; fewer where one key outweighs a part."""
    if not len(sample):
        return np.array([], "int64")
    ordered = sample.sort_values("key")
    total = ordered["weight"].cumsum().to_numpy()
    at = np.searchsorted(total, total[-1] * np.arange(1, ranges) / ranges)
    return np.unique(ordered["key"].to_numpy()[at])


def shard_by_size(documents: DataFrame, shards: int = 24, seed: int = 7) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Size: UTF-8 bytes plus OVERHEAD; a null text has no bytes and the checksum
    of the empty text. Law ``bytes``: sums of sizes differ by less than two
    records. Slots number the rows of a shard from 0 without gaps. Null and
    repeated ids and repeated rows are placed like any others. An empty table
    gives no rows. Other columns are ignored. The driver sees the sample, a
    count for each range and one number for each shard, all bounded by parameters.
    """
    facts = stash(documents.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.col("text")).alias("key"),
        F.xxhash64("doc_id", F.monotonically_increasing_id()).alias("sub_key")), "sizes")
    total = facts.agg(F.sum("size")).first()[0] or 0
    ranges = int(min(MOST_RANGES, max(LEAST_RANGES, total // RANGE_BYTES)))
    chance = F.least(F.lit(1.0), F.col("size") * (ranges * PER_RANGE / max(total, 1)))
    sample = (facts.withColumn("chance", chance).filter(F.rand(seed) < F.col("chance"))
              .select("key", (F.col("size") / F.col("chance")).alias("weight")).toPandas())
    cuts = boundaries(sample, ranges)

    @F.pandas_udf("int")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, key.to_numpy(), side="right").astype("int32"))

    ranged = facts.withColumn("range", range_of("key"))
    held = {r["range"]: (r["rows"], r["size"]) for r in
            ranged.groupBy("range").agg(F.count("*").alias("rows"), F.sum("size").alias("size")).collect()}
    fair = max(1, -(-sum(rows for rows, _ in held.values()) // ranges))
    n = len(cuts) + 1
    parts = [max(1, -(-held.get(i, (0, 0))[0] // (2 * fair))) for i in range(n)]
    rows_before = np.cumsum([0, *[held.get(i, (0, 0))[0] for i in range(n)]])
    size_before = np.cumsum([0, *[held.get(i, (0, 0))[1] for i in range(n)]])

    @F.pandas_udf("int")
    def part_of(range_: pd.Series, sub_key: pd.Series) -> pd.Series:
        width = np.array(parts)[range_.to_numpy()]
        return pd.Series(((sub_key.to_numpy().view("uint64") >> np.uint64(33)) % width.astype("uint64")).astype("int32"))

    cut = ranged.withColumn("part", part_of("range", "sub_key"))
    inside = Window.partitionBy("range").orderBy("part")
    starts = cut.groupBy("range", "part").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).select(
        F.col("range"), F.col("part"), (F.sum("rows").over(inside) - F.col("rows")).alias("rows_in"),
        (F.sum("bytes").over(inside) - F.col("bytes")).alias("bytes_in"))
    along = Window.partitionBy("range", "part").orderBy("key", "sub_key")

    @F.pandas_udf("struct<rows:long,bytes:long>")
    def before(range_: pd.Series) -> pd.DataFrame:
        at = range_.to_numpy()
        return pd.DataFrame({"rows": rows_before[at], "bytes": size_before[at]})

    laid = (cut.join(starts, ["range", "part"])
            .withColumn("row", F.row_number().over(along) - 1)
            .withColumn("offset", F.sum("size").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
            .withColumn("base", before("range")))
    first = F.col("base.bytes") + F.col("bytes_in") + F.col("offset")
    placed = stash(laid.select(
        "doc_id", "size", "text_crc32", F.floor(first * shards / max(total, 1)).cast("int").alias("shard"),
        (F.col("base.rows") + F.col("rows_in") + F.col("row")).alias("place")), "placed")
    firsts = dict(placed.groupBy("shard").agg(F.min("place")).collect())
    origin = F.get(F.lit([firsts.get(s, 0) for s in range(shards)]).cast("array<long>"), F.col("shard"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         (F.col("place") - origin).cast("long").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))
