import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import neighbours as n

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, every=n.EVERY):
    """Every product, added up from the first component on; ties to the smaller id."""
    least = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v):
            least[i] = min(least.get(i, v), v)
    out = []
    for q in (i for i in least if i % every == 0):
        scores = []
        for i, v in least.items():
            if i != q:
                total = 0.0
                for a, b in zip(v, least[q]):
                    total += a * b
                scores.append((-total, i))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[: n.NEAREST], 1)]
    return sorted(out)


def result(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"] and dict(df.dtypes)["rank"] == "int"
    return sorted(tuple(r) for r in df.collect())


def recall(got, expected):
    per_query = {q for q, *_ in expected}
    assert [r[:2] for r in got] == [r[:2] for r in expected] and {r[0] for r in got} == per_query
    return len({(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in expected}) / len(expected)


def frame(spark, x, ids=None, parts=4):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], SCHEMA).repartition(parts)


def units(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_small_tables_are_searched_whole(spark):
    x = np.random.default_rng(1).normal(size=(90, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    assert result(n.nearest_neighbours(frame(spark, x), every=7)) == plain(rows, 7)


@pytest.mark.parametrize("kind", ["random", "clusters", "lengths", "float"])
def test_recall(spark, monkeypatch, kind):
    """Cells small enough that most are not visited; lengths of vectors that differ much; single precision."""
    monkeypatch.setattr(n, "CELL_ROWS", 8)
    monkeypatch.setattr(n, "FIRST_ROWS", 160)
    rng = np.random.default_rng(5)
    x = units(rng.normal(size=(3000, 32)))
    if kind == "clusters":
        x = units(x[rng.integers(0, 60, 3000)] + 0.3 * units(rng.normal(size=(3000, 32))))
    if kind == "lengths":
        x = x * rng.uniform(0.2, 3, (3000, 1))
    df = frame(spark, x)
    if kind == "float":
        df = df.withColumn("embedding", F.col("embedding").cast("array<float>"))
        x = x.astype("float32").astype("float64")
    expected = plain([(i, v.tolist()) for i, v in enumerate(x)], 60)
    got = result(n.nearest_neighbours(df, every=60))
    assert recall(got, expected) >= 0.9
    exact = {(q, i): s for q, _, i, s in expected}
    assert all(exact[q, i] == s for q, _, i, s in got if (q, i) in exact)


def test_few_cells_are_visited_for_near_neighbours():
    """What is visited depends on how far the neighbours are, and thresholds keep pairs at their cosine."""
    rng = np.random.default_rng(2)
    assert n.cuts_for(64, 51_282) == (64,) and n.cuts_for(64, 77_000_000) == (64, 64) and n.cuts_for(64, 20) == (1,)
    hashes = n.Hashes(64, n.cuts_for(64, 9_000_000))
    assert hashes.cells > 1000
    limits = hashes.thresholds()
    assert (np.diff(limits) > 0).all()
    x = units(rng.normal(size=(400, 64)))
    away = rng.normal(size=(400, 64))
    away = units(away - (away * x).sum(1, keepdims=True) * x)
    for cosine, most in ((0.9, 0.02), (0.6, 0.25), (0.4, 0.6)):
        q = cosine * x + math.sqrt(1 - cosine**2) * away
        cells, found, visited = hashes.cell(x), 0, 0
        limit = limits[int(cosine / n.STEP)]
        for k in range(len(q)):
            visits = [n.beyond([p[0] for p in hashes.projections(q[k: k + 1], t)], limit, t) for t in range(n.TABLES)]
            found += any(cells[k, t] in v for t, v in enumerate(visits))
            visited += sum(map(len, visits)) / n.TABLES / hashes.cells
        assert found / len(q) >= 0.92 and visited / len(q) <= most


def test_probes_against_all_cells():
    rng = np.random.default_rng(3)
    hashes = n.Hashes(8, (8, 8, 4))
    p = [x[0] for x in hashes.projections(units(rng.normal(size=(1, 8))), 1)]
    total = (p[0][:, None, None] + p[1][None, :, None] + p[2][None, None, :]).ravel()
    for limit in (-9, 0.3, 1.1, 9):
        assert sorted(n.beyond(p, limit, 1) - hashes.cells) == np.flatnonzero(total >= limit).tolist()
    best = n.highest(p, 50, 1) - hashes.cells
    assert sorted(total[best]) == pytest.approx(sorted(total)[-50:])


def test_copies_and_hot_cells(spark, monkeypatch):
    """A third of the rows is one vector, a third nearly one: blocks of both sides, and ids in order among equals."""
    monkeypatch.setattr(n, "UNIT_ROWS", 16)
    monkeypatch.setattr(n, "PART_ROWS", 64)
    rng = np.random.default_rng(4)
    one = units(rng.normal(size=(1, 16)))
    x = np.concatenate([np.repeat(one, 200, 0), one + 0.01 * rng.normal(size=(200, 16)), rng.normal(size=(200, 16))])
    ids = rng.permutation(600)
    got = result(n.nearest_neighbours(frame(spark, x, ids), every=10))
    expected = plain([(int(i), v.tolist()) for i, v in zip(ids, x)], 10)
    assert recall(got, expected) >= 0.9
    of_copy = {int(i) for i in ids[:200] if i % 10 == 0}
    assert of_copy and [r for r in got if r[0] in of_copy] == [r for r in expected if r[0] in of_copy]


def test_odd_rows(spark):
    """Nulls, zeros, other lengths, values that aren't finite, repeated ids, ties, clashing names, empty tables."""
    one = [1.0, 2.0, 0.0, -1.0]
    rows = [(0, one), (1, one), (2, None), (3, []), (4, [0.0] * 4), (5, [None, 1.0]), (6, [math.nan, 1.0]), (7, [math.inf]),
            (None, one), (20, [1.0]), (20, [0.5, 9.0]), (21, [-0.0, 1.0]), (22, [0.0, 1.0]), (40, [-3.0, 0.0, 0.0, 0.0, 7.0]),
            (0, one), (60, None), (80, [0.0]), (-20, [1e-3, 2e-3]), (9, [1e6, 1.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("v", "q", "cells", "unit", "part", "score", "rank", "least"):
        df = df.withColumn(name, F.lit("z"))
    assert result(n.nearest_neighbours(df)) == plain(rows)
    assert result(n.nearest_neighbours(df.limit(0))) == []
    assert result(n.nearest_neighbours(df.filter("vec_id = 40"))) == []
    assert result(n.nearest_neighbours(df.filter("vec_id = 60"))) == []
