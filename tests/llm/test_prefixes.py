import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.llm import prefixes as p
from millrace.llm.oracles import OP11

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "n_ends"]
SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """The same by lists of turns."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(ts)] for c, ts in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in turns:
        h, rest = zlib.crc32(str(c).encode()) % 6, abs(c) % 100 * (1 if c >= 0 else -1)
        whole = (*turns.get(c - rest, [])[:h], *turns[c][h:])
        ends[whole].append(c)
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
    children = Counter(k[:-1] for k in members if k)
    saved, leaves = Counter(), Counter()
    for k, ms in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(ms) - 1) * len(k[-1][1]) if k else 0
    return sorted((min(ms), len(k), min(members[k[:-1]]) if k else None, len(ms), children[k], leaves[k], saved[k],
                   hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest(), len(ends[k]))
                  for k, ms in members.items())


def result(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


def families(seed, n=60):
    """Few texts, so that many conversations share turns; some are prefixes of others, some are alike."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample([*range(0, 130), 200, 201, 305, -7, -100, -200, 1005], n):
        rows += [(c, t, rng.choice(["user", "user", None]), rng.choice(["ab", "ab", "é\U0001F600", "", None]))
                 for t in range(rng.choice([1, 2, 2, 3, 8]))]
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_against_lists(spark, seed):
    rows = families(seed)
    random.Random(seed).shuffle(rows)
    assert result(p.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_odd_rows(spark):
    """Null numbers, roles, texts and ids; ties, repeated rows, very long texts; columns whose names clash."""
    rows = [(5, None, None, None), (5, 2, "b", "x"), (5, 2, "a", "y"), (5, 2, "a", "x"), (5, 2, "a", "x"), (None, 1, "u", "t"),
            (100, 1, "u", "t" * 200_000), (100, None, "u", ""), (101, 7, None, "t"), (7, 0, "u", "\n\t "), (8, 0, "u", "\n\t ")]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("place", "depth", "x", "y", "size", "head", "first", "ids", "leaf", "owner"):
        df = df.withColumn(c, F.lit("z"))
    assert result(p.prefix_trie(df)) == plain(rows)
    assert result(p.prefix_trie(df.limit(0))) == []
    assert result(p.prefix_trie(df.filter("conv_id IS NULL"))) == []


def test_hot_conversation_and_long_one(spark, monkeypatch):
    """A third of the rows in one conversation, a third in copies of another; lists of ids in several pieces."""
    monkeypatch.setattr(p, "LISTED", 7)
    rows = [(3, t, "u", f"t{t % 5}") for t in range(400)]
    rows += [(c, t, "u", "same") for c in range(1000, 1200) for t in range(2)] + families(9, 40)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(p.prefix_trie(df)) == plain(rows)


def test_sql_agrees(spark):
    rows = [r for r in families(11) if r[0] >= 0]
    duck = duckdb.connect()
    duck.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    duck.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    found = duck.execute(f"SELECT {', '.join(COLUMNS)} FROM ({OP11})").fetchall()
    assert sorted(found, key=lambda r: r[:2]) == plain(rows)
