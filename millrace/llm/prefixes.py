"""Prefix trie of conversations, by collapsing whole sequences.

Turns are reduced to two 64-bit hashes and a length before anything is shuffled.
A sequence of turns is named by the exclusive or of its turns' hashes, each mixed
with the turn's place; so the names of all prefixes are running values, and need
no list of turns. Conversations of equal sequences collapse into one sequence with
a weight, its smallest id, and the list of those that end there. Sequences that no
longer one begins with, found by an anti-join, are the leaves. What is left to do
is to add up weights over the prefixes of the distinct sequences, in work linear in
their turns: a subtree's cost is the sum over its sequences of what follows, less
each node's text once, which its owner, the sequence of the smallest id, counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import small_or_not, stash
from millrace.operators.running import running_aggregates

#: Conversations of one family share the first turns of the one whose id is the family's smallest multiple.
FAMILY, HEADS = 100, 6
#: Characters of a text that order turns of the same number and role; beyond, a hash does.
ORDERING = 32
#: Ids that are joined to one text before they are sent to the task that hashes a node's list.
LISTED = 10_000
NAME = ("depth", "x", "y")


def head_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes over from its family's first."""
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def placed(h: str, place: Column) -> Column:
    return F.xxhash64(place.cast("long"), F.col(h))


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, h1, h2, size): turns in order, from 1, without their texts.

    The running count cuts a conversation of very many turns into chunks, so
    it need not fit in one task.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.left(text, F.lit(ORDERING)).alias("begin"), F.xxhash64(F.lit(1), role, text).alias("h1"),
        F.xxhash64(F.lit(2), role, text).alias("h2"), F.char_length(text).cast("long").alias("size"))
    # Nulls come first in Spark's ascending order; rows equal in all of these are interchangeable.
    order = ["turn", "role", "begin", "h1", "h2"]
    counted = running_aggregates(turns.withColumn("one", F.lit(1)), ["conv_id"], order, {"place": ("sum", "one")})
    return counted.select("conv_id", F.col("place").cast("long").alias("place"), "h1", "h2", "size")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, d1, d2, size): each conversation with its family's head, and a row of depth 0 for its start."""
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = stash(turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("place") < HEADS)).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "h1", "h2", "size"))).alias("head")).withColumnRenamed(
        "conv_id", "base"), "heads")
    heads = small_or_not(heads)

    def taken(df: DataFrame) -> DataFrame:
        head = F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1),
                       head_turns(F.col("conv_id")).cast("int"))
        return df.withColumn("base", base).join(heads, "base", "left").withColumn("head", head)

    def row(place: Column) -> list[Column]:
        return [place.cast("long").alias("depth"), placed("h1", place).alias("d1"), placed("h2", place).alias("d2")]

    starts = turns.filter("place = 1")
    shared = taken(starts.select("conv_id")).select("conv_id", F.inline("head")).select(
        "conv_id", *row(F.col("place")), "size")
    own = taken(turns.filter(F.col("place") > head_turns(F.col("conv_id")))).select(
        "conv_id", *row(F.col("place") - head_turns(F.col("conv_id")) + F.size("head")), "size")
    zero = F.lit(0).cast("long")
    roots = starts.select("conv_id", zero.alias("depth"), zero.alias("d1"), zero.alias("d2"), zero.alias("size"))
    return shared.unionByName(own).unionByName(roots)


def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Ids sorted by node, LISTED at a time as one text; cuts may fall anywhere."""
    for pdf in batches:
        names = [pdf[c].to_numpy() for c in NAME]
        fresh = np.ones(len(pdf), bool)
        fresh[1:] = np.logical_or.reduce([a[1:] != a[:-1] for a in names])
        starts = np.flatnonzero(fresh)
        cuts = np.unique(np.concatenate([np.arange(a, b, LISTED) for a, b in zip(starts, np.append(starts[1:], len(pdf)))])
                         if len(pdf) else starts)
        ids = pdf["conv_id"].tolist()
        yield pd.DataFrame({c: pdf[c].to_numpy()[cuts] for c in NAME} | {
            "least": pdf["conv_id"].to_numpy()[cuts],
            "ids": [",".join(map(str, ids[a:b])) for a, b in zip(cuts, np.append(cuts[1:], len(ids)))]})


def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each node's lists of ids, which arrive in order; only its running state is held."""
    node, state = None, hashlib.sha256()
    for pdf in batches:
        done = []
        for *name, ids in zip(*(pdf[c] for c in NAME), pdf["ids"]):
            if name == node:
                state.update(b",")
            else:
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = name, hashlib.sha256()
            state.update(ids.encode())
        yield pd.DataFrame(done, columns=[*NAME, "ends"])
    if node is not None:
        yield pd.DataFrame([(*node, state.hexdigest())], columns=[*NAME, "ends"])


def end_hashes(whole: DataFrame) -> DataFrame:
    """The hash of the ids that end at a node, however many: cut evenly by node and id, joined, then hashed in order."""
    name = "depth long, x long, y long"
    lists = whole.select("conv_id", *NAME).repartitionByRange(*NAME, "conv_id").sortWithinPartitions(
        *NAME, "conv_id").mapInPandas(listed, f"{name}, least long, ids string")
    return lists.repartition(*NAME).sortWithinPartitions(*NAME, "least").mapInPandas(hashed, f"{name}, ends string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations.

    Columns conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, n_ends, as the task's contract has them; n_ends
    counts the conversations that end at the node.

    Turns are ordered by number, null first; of equal numbers by role, by the
    first ORDERING characters of the text, then by a hash. Null roles and
    texts are empty. Rows without conv_id are left out. Repeated rows are
    turns of their own. An empty table has no conversations and no root.
    Other columns are ignored. Remainders of negative ids are Spark's.
    """
    turns = stash(numbered(conversations), "turns")
    rows = stash(rebuilt(turns), "rebuilt")

    # Whole sequences, collapsed.
    whole = stash(rows.groupBy("conv_id").agg(
        F.max("depth").alias("depth"), F.bit_xor("d1").alias("x"), F.bit_xor("d2").alias("y"),
        F.sum("size").alias("total")), "whole")
    sequences = stash(whole.groupBy(*NAME).agg(
        F.min("conv_id").alias("first"), F.count("*").alias("weight"), F.min("total").alias("total")), "sequences")
    ends = stash(end_hashes(whole), "ends")

    # Prefixes of one conversation for each sequence; their names, and the text before each, are running values.
    kept = sequences.select(F.col("first").alias("conv_id"))
    running = {"x": ("xor", "d1"), "y": ("xor", "d2"), "upto": ("sum", "size")}
    prefixes = stash(running_aggregates(
        rows.join(small_or_not(kept), "conv_id", "left_semi"), ["conv_id"], ["depth"], running).select(
        "conv_id", "depth", "d1", "d2", "x", "y", (F.col("upto") - F.col("size")).alias("before")), "prefixes")
    longer = prefixes.join(sequences.select(F.col("first").alias("conv_id"), F.col("depth").alias("length")), "conv_id")
    leaves = sequences.join(longer.filter("depth < length").select(*NAME).distinct(), list(NAME), "left_anti").select(
        F.col("first").alias("conv_id"), F.lit(1).alias("leaf"))

    # A sequence owns the nodes from where no smaller id goes along.
    owners = prefixes.groupBy(*NAME).agg(F.min(F.struct("conv_id", "before")).alias("owner"))
    owned = owners.groupBy(F.col("owner.conv_id").alias("conv_id")).agg(
        F.min(F.struct("depth", "owner.before")).alias("from"))
    about = stash(sequences.select(F.col("first").alias("conv_id"), "weight", "total").join(owned, "conv_id", "left").join(
        leaves, "conv_id", "left").select("conv_id", "weight", "total", F.coalesce("leaf", F.lit(0)).alias("leaf"),
                                          F.col("from.depth").alias("since"), F.col("from.before").alias("owned")), "about")
    after = F.col("total") - F.col("before")
    once = F.when(F.col("since").isNull(), 0).when(F.col("depth") >= F.col("since"), after).otherwise(
        F.col("total") - F.col("owned"))
    parent = F.struct((F.col("depth") - 1).alias("depth"), F.col("x").bitwiseXOR(F.col("d1")).alias("x"),
                      F.col("y").bitwiseXOR(F.col("d2")).alias("y"))
    nodes = stash(prefixes.join(about, "conv_id").groupBy(*NAME).agg(
        F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"),
        (F.sum(F.col("weight") * after) - F.sum(once)).alias("saved_tokens"), F.min(parent).alias("parent")), "nodes")

    children = nodes.filter("depth > 0").groupBy("parent").agg(F.count("*").alias("n_children"))
    above = nodes.select(F.struct(*NAME).alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    counts = stash(above.join(children, "parent", "left").select(
        "parent", "parent_conv_id", F.coalesce("n_children", F.lit(0)).alias("n_children")), "children")
    here = counts.select(*[F.col(f"parent.{c}").alias(c) for c in NAME], "n_children")
    n_ends = sequences.select(*NAME, F.col("weight").alias("n_ends"))
    out = nodes.join(counts.select("parent", "parent_conv_id"), "parent", "left").join(here, list(NAME)).join(
        n_ends, list(NAME), "left").join(ends, list(NAME), "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(nothing)).alias("ends_sha256"), F.coalesce("n_ends", F.lit(0)).alias("n_ends"))
