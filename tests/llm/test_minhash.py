import random
import re
from collections import defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from llm_cases import by_id
from millrace.llm import minhash


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1)))


def plain(pairs, percent=85):
    """Components over all pairs of documents."""
    sets = {i: shingle_set(t) for i, t in pairs}
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    inverted = defaultdict(set)
    for i, s in sets.items():
        for g in s:
            inverted[g].add(i)
    for a, b in {p for ids in inverted.values() for p in combinations(sorted(ids), 2)}:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            up[y] = x
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def edited(words, rng, edits):
    words = list(words)
    for _ in range(edits):
        i = rng.randrange(len(words))
        kind = rng.random()
        if kind < 0.5:
            words[i] = f"e{rng.randint(0, 9)}"
        elif kind < 0.8:
            del words[i]
        else:
            words.insert(i, f"i{rng.randint(0, 9)}")
    return words


def family_texts(seed, base_first=True):
    """Families of copies with few and many edits, chains of edits, parts of a long text, and strangers."""
    rng = random.Random(seed)
    texts = []
    for _ in range(4):
        base = [f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(60, 160))]
        family = [edited(base, rng, rng.randint(0, 6)) for _ in range(60)]
        chain = [base]
        for _ in range(12):
            chain.append(edited(chain[-1], rng, 1))
        texts += ([base] if base_first else []) + family + chain + [base, base]
    long = [f"l{i}" for i in range(400)]
    texts += [long] + [long[: rng.randint(150, 400)] for _ in range(25)]
    texts += [[f"s{rng.randint(0, 10**6)}" for _ in range(rng.randint(1, 50))] for _ in range(40)]
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize(("seed", "base_first"), [(0, True), (1, False)])
def test_components(documents, seed, base_first):
    pairs = list(enumerate(family_texts(seed, base_first)))
    got = by_id(minhash.near_duplicates(documents(pairs)), "n_shingles", "component_id", "kept")
    assert got == plain(pairs)


def test_odd_rows(odd, documents):
    rows = minhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert [(r["component_id"], r["kept"]) for r in rows if r["doc_id"] is None] == [(None, True)]
    found = {r["doc_id"]: r for r in rows if r["doc_id"] not in (None, 3)}
    assert [found[i]["n_shingles"] for i in (0, 1, 2, 4)] == [0, 0, 0, 1]
    assert found[9]["component_id"] == 8 and not found[9]["kept"]
    assert found[0]["component_id"] == 0 and found[1]["component_id"] == 1
    assert minhash.near_duplicates(odd.limit(0)).collect() == []
    kept = minhash.one_of_each(odd)
    assert kept.columns == odd.columns and kept.filter("doc_id = 9").count() == 0
    assert kept.filter("doc_id IS NULL").count() == 1


def test_estimate(spark):
    """The estimate is close to the true similarity and corrects for lanes that agree by chance."""
    rng = random.Random(3)
    pool = [f"p{i}" for i in range(4000)]
    texts = []
    for share in (0.0, 0.5, 0.9):
        a = rng.sample(pool, 1000)
        b = a[: int(1000 * share)] + rng.sample(pool, 1000 - int(1000 * share))
        texts += [" ".join(a), " ".join(b)]
    signs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").mapInPandas(
        minhash.signed, "doc_id long, n_shingles long, set_hash binary, sig array<long>, bands array<long>")
    a = signs.filter("doc_id % 2 = 0").select((F.col("doc_id") + 1).alias("doc_id"), F.col("sig").alias("a"))
    got = by_id(a.join(signs, "doc_id").select("doc_id", minhash.estimate(F.col("a"), F.col("sig")).alias("e")), "e")
    for k in range(3):
        x, y = shingle_set(texts[2 * k]), shingle_set(texts[2 * k + 1])
        assert abs(got[2 * k + 1][0] - len(x & y) / len(x | y)) < 0.3  # four deviations


def test_components_of_paths(spark):
    """A long path, a star and a loop."""
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 40)] + [(70, 71), (71, 72), (70, 72), (1, 1)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in minhash.components(df).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 5 for i in range(5, 40)} | {i: 70 for i in (70, 71, 72)}
    assert got == want


def test_ids_that_repeat(documents):
    """Rows of one id are one document with the links of each of its texts; also if it is the smallest id of both."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    got = by_id(minhash.near_duplicates(documents([(0, a), (1, a), (1, b), (2, a), (3, b), (4, c)])), "component_id")
    assert {i: x for i, (x,) in got.items()} == {0: 0, 1: 0, 2: 0, 3: 0, 4: 4}
    docs = documents([(1, a), (1, b), (2, a + " end"), (3, b + " end"), (5, c), (5, c), (5, None), (6, c + " end")])
    rows = [(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect()]
    assert sorted(rows) == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (5, 5, True), (5, 5, True), (5, 5, True),
                            (6, 5, False)]


def test_parts_of_a_longer_text(documents):
    """Excerpts much shorter than the pivot: linked among themselves, by what lies inside it, and not with it."""
    rng = random.Random(5)
    long = [f"l{i}" for i in range(300)]
    cuts = [long[a: a + n] for a, n in ((rng.choice([0, 3, 40, 44, 90]), rng.randint(225, 250)) for _ in range(30))]
    pairs = list(enumerate([" ".join(long)] + [" ".join(c) for c in cuts] + [" ".join(c) for c in cuts[:3]]))
    for percent in (80, 85):
        got = by_id(minhash.near_duplicates(documents(pairs), percent), "n_shingles", "component_id", "kept")
        assert got == plain(pairs, percent)


def test_pairs_found(spark, documents):
    """Of all pairs at the threshold or above, by comparing everything, none is left apart: at 0.85 and at 0.80."""
    rng = random.Random(11)
    texts = []
    for _ in range(25):
        base = [f"w{rng.randint(0, 9000)}" for _ in range(rng.randint(80, 200))]
        texts += [base] + [edited(base, rng, rng.randint(1, 4)) for _ in range(3)]
    pairs = list(enumerate(" ".join(t) for t in texts))
    for percent in (80, 85):
        got = by_id(minhash.near_duplicates(documents(pairs), percent), "n_shingles", "component_id", "kept")
        assert got == plain(pairs, percent)
