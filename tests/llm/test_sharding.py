import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from millrace.llm import sharding


def checked(df, pairs, shards=24):
    rows = df.collect()
    assert len(rows) == len(pairs)
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in pairs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    assert all(r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards for r in rows)
    slots, sums = {}, Counter({s: 0 for s in range(shards)})
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        sums[r["shard"]] += r["size"]
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    largest = max((r["size"] for r in rows), default=0)
    assert max(sums.values()) - min(sums.values()) < 2 * largest + 1
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_sizes_are_near_equal(documents, seed):
    """A third of the rows are one text, some are long, some rows repeat."""
    rng = random.Random(seed)
    pairs = [(i, "hot" * 20 if i % 3 == 0 else "x" * int(rng.paretovariate(1.1) * 20)) for i in range(4000)]
    pairs += [(5, "same row")] * 300 + [(None, None), (None, "é")]
    rows = checked(sharding.shard_by_size(documents(pairs)), pairs)
    hot = Counter(r["shard"] for r in rows if r["text_crc32"] == zlib.crc32(b"hot" * 20))
    assert len(hot) <= 24 and sum(hot.values()) == 1334


def test_few_shards_and_rows(documents, odd):
    pairs = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    checked(sharding.shard_by_size(odd, shards=3), pairs, 3)
    assert sharding.shard_by_size(odd.limit(0)).collect() == []
    checked(sharding.shard_by_size(documents([(1, "only")])), [(1, "only")])


def test_boundaries_follow_weight():
    rng = np.random.default_rng(0)
    sample = pd.DataFrame({"key": rng.integers(-10**6, 10**6, 5000), "weight": rng.pareto(2, 5000) + 1})
    cuts = sharding.boundaries(sample, 8)
    part = np.searchsorted(cuts, sample["key"], side="right")
    weights = np.bincount(part, sample["weight"])
    assert len(cuts) == 7 and weights.max() < 1.2 * weights.mean()
    assert len(sharding.boundaries(sample.assign(key=3), 8)) == 1
