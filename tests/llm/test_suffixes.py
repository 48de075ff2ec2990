import random
from hashlib import sha256

import numpy as np
import pandas as pd
import pytest

from millrace.llm import suffixes as s


def plain(pairs):
    """Every 50-byte string against those of all smaller ids."""
    out, first = [], {}
    for i, t in pairs:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            g = b[p:p + 50]
            first[g] = min(first.get(g, s.NO_ID), s.NO_ID if i is None else i)
    for i, t in pairs:
        b = (t or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < (s.NO_ID if i is None else i):
                gone[p:p + 50] = [True] * 50
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def texts(seed):
    rng = random.Random(seed)
    pool = ["".join(rng.choices("abcdeé \n\0", k=rng.randint(30, 140))) for _ in range(25)]
    pool += ["=" * 70, "ab" * 60, "\0" * 60, "Licensed under the same words as everyone else, without warranties. "]
    return ["".join(rng.choices(pool, k=rng.randint(0, 6))) for _ in range(80)]


@pytest.mark.parametrize(("seed", "hot", "shard"), [(0, s.HOT, s.SHARD_BYTES), (1, 2, 3000), (2, 3, 500)])
def test_against_all_strings(spark, documents, monkeypatch, seed, hot, shard):
    """One shard and many, anchors dealt whole and string by string."""
    for name, value in (("HOT", hot), ("SHARD_BYTES", shard), ("PART_BYTES", 4000), ("BLOCK_BYTES", 1000), ("CHUNK_BYTES", 777)):
        monkeypatch.setattr(s, name, value)
    pairs = list(enumerate(texts(seed)))
    random.Random(seed).shuffle(pairs)
    pairs += [(7, pairs[3][1]), (None, pairs[5][1]), (None, None), (200, "")]
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in s.digest(documents(pairs).repartition(3)).collect()]
    assert sorted(got, key=str) == plain(pairs)


@pytest.mark.parametrize("seed", range(4))
def test_suffix_array(seed):
    rng = random.Random(seed)
    alphabet = [b"ab", b"a", b"\0a", bytes(range(256))][seed]
    text = bytes(rng.choices(alphabet, k=700)) + bytes(rng.choices(alphabet, k=60)) * 3
    body = np.frombuffer(text, "uint8")
    order, close = s.suffix_array(body)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    prefix = s.common_prefixes(body, order, 50)
    part = s.common_prefixes(body, order, 50, close)
    for k in range(1, len(order)):
        a, b = text[order[k - 1]:][:50], text[order[k]:][:50]
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert prefix[k] == n and part[k] == (n if n >= s.PROVED else 0)


def test_odd_rows(odd):
    rows = s.without_repeats(odd).collect()
    assert len(rows) == odd.count()
    assert s.digest(odd.limit(0)).collect() == []
    by = {r["doc_id"]: r for r in rows if r["doc_id"] not in (None, 3)}
    assert (by[0]["n_bytes"], by[0]["n_removed"]) == (0, 0) and by[6]["n_removed"] == 0
    assert bytes(by[10]["kept"]) == b"tab\tvt\x0bff\x0cend"


def test_occurrences_come_back():
    rng = np.random.default_rng(6)
    piece, known = np.empty(400, "int64"), 0
    for k in range(400):
        new = known == 0 or rng.random() < 0.5
        piece[k] = known if new else rng.integers(0, known)
        known += new
    low, size = rng.integers(0, 10**6, 400), rng.integers(1, 35, 400)
    for mine in (slice(None), slice(0, 1), slice(0, 0)):
        got = s.occurrences(s.noted(piece[mine], low[mine], size[mine]))
        for a, b in zip(got, (piece, low, size)):
            assert a.tolist() == b[mine].tolist()


def test_lists_merge_in_halves(monkeypatch):
    """Where each list's strings have come to be; and a string takes part in one search for each doubling, not for each list."""
    rng = np.random.default_rng(4)
    blocks = [(np.unique(rng.integers(1000, 5000, 300).astype(f"S{s.LENGTH}")), None) for _ in range(16)]
    blocks = [(strings, rng.integers(0, 99, len(strings))) for strings, _ in blocks]
    searched, plain_search = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda a, v, *more: searched.append(len(a) + len(v)) or plain_search(a, v, *more))
    strings, best, places = s.merged(blocks)
    want = {}
    for theirs, ids in blocks:
        for t, i in zip(theirs.tolist(), ids.tolist()):
            want[t] = min(i, want.get(t, i))
    assert dict(zip(strings.tolist(), best.tolist())) == want and strings.tolist() == sorted(want)
    assert all((strings[at] == theirs).all() for at, (theirs, _) in zip(places, blocks))
    assert sum(searched) <= 4 * sum(len(theirs) for theirs, _ in blocks)
    alone = s.merged(blocks[:1])
    assert alone[0].tolist() == blocks[0][0].tolist() and alone[2][0].tolist() == list(range(len(blocks[0][0])))


def steps(pairs, parts=1, each=None):
    """The steps without Spark; ``each`` documents make a shard."""
    each = each or len(pairs)
    shards = pd.concat(f for k in range(0, len(pairs), each)
                       for f in s.pack(parts)(iter([pd.DataFrame(pairs[k:k + each], columns=["doc_id", "text"])])))
    bodies, asks = shards[shards["body"].notna()], shards[shards["part"].notna()]
    wanted = pd.concat([s.in_common(g) for _, g in asks.groupby("part")])
    pieces = pd.concat([s.cut_out(parts, b"")(b, wanted[wanted["shard"] == k]) for k, b in bodies.groupby("shard")])
    told = pd.concat([s.answered(b"")(g) for _, g in pieces.groupby("part")] or [pieces])
    out = pd.concat([s.finished(b, told[told["shard"] == k]) for k, b in bodies.groupby("shard")])
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, sha256(r.kept).hexdigest()) for r in out.itertuples()), key=str)


def letters(rng, n):
    return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))


def test_what_short_pieces_share_stays(monkeypatch):
    """Texts that share no more than 20 bytes here and there send no stretches."""
    rng = random.Random(1)
    common = [letters(rng, 20) for _ in range(30)]
    pairs = [(i, "".join(letters(rng, 20) + rng.choice(common) for _ in range(60))) for i in range(40)]
    sent = []
    noted = s.noted
    monkeypatch.setattr(s, "noted", lambda piece, *more: sent.append(len(piece)) or noted(piece, *more))
    assert steps(pairs, 3, 10) == plain(pairs)
    assert sum(sent) == 0


def test_equal_stretches_need_no_suffix_array(monkeypatch):
    """Of a long passage that several documents have, only what lies at its ends meets in suffix arrays."""
    rng = random.Random(2)
    passage = letters(rng, 3000)
    pairs = [(i, letters(rng, 400) + passage + letters(rng, 400)) for i in range(12)]
    seen = []
    distinct = s.distinct_strings
    monkeypatch.setattr(s, "distinct_strings", lambda pieces, ids: seen.extend(pieces) or distinct(pieces, ids))
    assert steps(pairs, 2, 3) == plain(pairs)
    assert all(text.decode() not in passage or k < 100 or k > 2800 for text in seen for k in [passage.find(text.decode())])
    assert 0 < sum(map(len, seen)) < len(pairs) * 400


def test_hot_strings_are_dealt_once(monkeypatch):
    """A hot anchor's strings are dealt once for each stretch that differs, not for each occurrence."""
    monkeypatch.setattr(s, "HOT", 10)
    rng = random.Random(3)
    line = letters(rng, 200)
    pairs = [(i, letters(rng, 60).join([line] * 20)) for i in range(6)]
    dealt = []
    crc32 = s.crc32
    monkeypatch.setattr(s, "crc32", lambda text: dealt.append(text) or crc32(text))
    assert steps(pairs, 3, 2) == plain(pairs)
    assert 0 < len(dealt) < 6 * 20 * 150 / 3


@pytest.mark.parametrize("hot", [3, 10**6])
def test_steps_of_many_shards(monkeypatch, hot):
    for name, value in (("HOT", hot), ("BLOCK_BYTES", 500), ("CHUNK_BYTES", 300)):
        monkeypatch.setattr(s, name, value)
    pairs = [(3 * i % 80, t) for i, t in enumerate(texts(5))] + [(9, "x" * 49), (4, "ab" * 60)]
    assert steps(pairs, 7, 4) == plain(pairs)


def test_copies_joined_or_broadcast(spark, documents, monkeypatch):
    """Many copies are joined, few are broadcast: the same rows, also of ids that have several texts."""
    pairs = list(enumerate(texts(6)[:30] * 2)) + [(40, "q" * 80), (40, texts(6)[3]), (None, texts(6)[4])]
    for copies in (0, 10**6):
        monkeypatch.setattr(s, "COPIES", copies)
        got = [tuple(r) for r in s.digest(documents(pairs)).collect()]
        assert sorted(got, key=str) == plain(pairs)
