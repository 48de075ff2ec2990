import random
from collections import Counter

import duckdb
import pytest

from millrace.llm import decontaminate as d
from millrace.llm.oracles import OP4


def words(rng, n, pool=60):
    return [f"v{rng.randint(0, pool)}" for _ in range(n)]


def grams(ws):
    return [tuple(ws[i:i + 5]) for i in range(len(ws) - 4)]


def plain(docs, items, percent=80):
    """Every window of every item's size, or the whole of a shorter text."""
    out = set()
    for i, text in docs:
        ws = (text or "").lower().split()
        for k, item in items:
            bag = Counter(grams(item.lower().split()))
            size, n = len(item.split()), sum(bag.values())
            best, held = (0, 0), min(size, len(ws))
            if not n:
                continue
            for s in range(len(ws) - held + 1):
                both = sum((Counter(grams(ws[s:s + held])) & bag).values())
                if 100 * both >= percent * (n + held - 4 - both):
                    best = max(best, (both, -s))
            if best[0]:
                out.add((i, k, -best[1], held, best[0], best[0] / (n + held - 4 - best[0])))
    return out


def data(seed):
    rng = random.Random(seed)
    items = [(k, " ".join(words(rng, rng.randint(3, 40), 2000))) for k in range(12)]
    items += [(20, " ".join(["again and again we"] * 8)), (21, items[4][1]), (22, "")]
    docs = []
    for i in range(60):
        ws = words(rng, rng.randint(0, 80), 2000)
        if i % 2:
            leak = rng.choice(items)[1].split()
            for _ in range(rng.randint(0, 2)):
                if leak:
                    leak[rng.randrange(len(leak))] = "edit"
            at = rng.randint(0, len(ws))
            ws[at:at] = [w.upper() for w in leak]
        docs.append((i, " ".join(ws)))
    return docs + [(60, docs[1][1]), (61, None), (62, "")], items


COLUMNS = ("doc_id", "item_id", "start", "n_words", "shared", "similarity")


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("in_plan", [d.IN_PLAN, 0])
def test_against_all_windows(spark, documents, monkeypatch, seed, in_plan):
    """Both ways to search, the benchmark inside the plan and joined."""
    docs, items = data(seed)
    monkeypatch.setattr(d.windows_worth_a_look, "__defaults__", (in_plan,))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = d.find_benchmark(documents(docs), benchmark)
    assert {tuple(r[c] for c in COLUMNS) for r in got.collect()} == plain(docs, items)
    hit = {i for i, *_ in plain(docs, items)}
    left = d.without_benchmark(documents(docs), benchmark)
    assert {r["doc_id"] for r in left.collect()} == {i for i, _ in docs} - hit


def test_odd_rows(spark, odd):
    items = [(1, "the same text twice over and over again"), (None, "x y x y x y"), (2, None), (3, "word")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = {(r["doc_id"], r["item_id"]) for r in d.find_benchmark(odd, benchmark).collect()}
    assert rows == {(8, 1), (9, 1), (7, None)}
    assert d.find_benchmark(odd.limit(0), benchmark).collect() == []
    assert d.find_benchmark(odd, benchmark.limit(0)).collect() == []
    assert d.without_benchmark(odd, benchmark.limit(0)).count() == odd.count()
    assert d.without_benchmark(odd, benchmark).columns == odd.columns


def test_index_misses_nothing():
    """Any two fingerprints within the radius meet in a block."""
    rng = random.Random(1)
    masks = set(d.flips(d.WIDTH, d.RADIUS // d.BLOCKS))
    for _ in range(3000):
        x = sum(1 << b for b in rng.sample(range(64), rng.randint(0, d.RADIUS)))
        assert any((x >> (d.WIDTH * i)) % 2**d.WIDTH in masks for i in range(d.BLOCKS))


@pytest.mark.parametrize("in_plan", [d.IN_PLAN, 0])
def test_texts_shorter_than_the_item(spark, documents, monkeypatch, in_plan):
    """A text of fewer words than an item is one window; a shorter one too dissimilar is clean."""
    monkeypatch.setattr(d.windows_worth_a_look, "__defaults__", (in_plan,))
    rng = random.Random(7)
    items = [(k, words(rng, n, 5000)) for k, n in enumerate((37, 20, 12, 54))] + [(4, ["we", "go"] * 14)]
    docs = [(100 * k + cut, " ".join(item[cut // 2:len(item) - (cut - cut // 2)])) for k, item in items for cut in range(9)]
    want = set()
    for i, text in docs:
        ws = text.split()
        for k, item in items:
            if len(ws) <= len(item):
                a, b = Counter(grams(ws)), Counter(grams(item))
                both, n = sum((a & b).values()), sum(a.values()) + sum(b.values())
                if both and 100 * both >= 80 * (n - both):
                    want.add((i, k, 0, len(ws), both, both / (n - both)))
    assert {(1, 0), (101, 1), (301, 3), (8, 0)} - {x[:2] for x in want} == {(8, 0)}
    benchmark = spark.createDataFrame([(k, " ".join(x)) for k, x in items], "item_id long, text string")
    got = d.find_benchmark(documents(docs), benchmark).collect()
    assert {tuple(r[c] for c in COLUMNS) for r in got} == want
    left = d.without_benchmark(documents(docs), benchmark)
    assert {r["doc_id"] for r in left.collect()} == {i for i, _ in docs} - {x[0] for x in want}


def test_sql_agrees_on_shorter_texts(spark, documents):
    """The SQL has the same rule where a text has fewer words than an item."""
    rng = random.Random(3)
    items = [(k, words(rng, n, 5000)) for k, n in enumerate((37, 20, 12, 54))]
    docs = [(100 * k + cut, " ".join(item[cut // 2:len(item) - (cut - cut // 2)] + words(rng, 3) * (cut % 3 == 2)))
            for k, item in items for cut in range(9)]
    items = [(k, " ".join(x)) for k, x in items]
    duck = duckdb.connect()
    for name, rows, key in (("documents", docs, "doc_id"), ("benchmark", items, "item_id")):
        duck.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
        duck.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    found = {tuple(r) for r in duck.execute(f"SELECT {', '.join(COLUMNS)} FROM ({OP4})").fetchall()}
    got = d.find_benchmark(documents(docs), spark.createDataFrame(items, "item_id long, text string"))
    assert found == {tuple(r[c] for c in COLUMNS) for r in got.collect()} == plain(docs, items)
    assert any(r[3] < 37 for r in found if r[1] == 0)
