import random
from hashlib import sha256

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from llm_cases import by_id
from millrace.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
VOCABULARY = bpe.read_vocabulary(PATH)
RANKS = {t: r for r, t in enumerate(VOCABULARY.tokens)}
PEER = tiktoken.Encoding("peer", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def texts():
    rng = random.Random(2)
    parts = ["the", " The", "don't", "we'll", "'s", "123", " 45", "é", "ß", "日本", "\U0001F600", " ", "　", "  ", "\n\n", "\t",
             "!!", " ??", "<|endoftext|>", "Ωμέγα", "\x85", "​", "aaaaaaa", "ciónñarr", "thtionre", "\r\n", "́", "\0"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(150)] + [
        "<|endoftext|> is plain text", " ", "  x", "x  ", "\n \n x", "ab" * 400, "'S 'LL"]


@pytest.mark.parametrize("size", [0, 5, bpe.DICTIONARY])
def test_same_ids_as_the_library(documents, size):
    """Whatever the dictionary holds."""
    want = {i: tuple(PEER.encode_ordinary(t)) for i, t in enumerate(texts())}
    docs = bpe.encode(documents(enumerate(texts())), VOCABULARY, size=size)
    assert {r["doc_id"]: tuple(r["ids"]) for r in docs.collect()} == want
    back = bpe.decode(docs, VOCABULARY)
    assert {r["doc_id"]: bytes(r["bytes"]) for r in back.collect()} == {i: t.encode() for i, t in enumerate(texts())}


def test_digest_and_odd_rows(odd, documents):
    rows = bpe.digest(odd, VOCABULARY).collect()
    assert len(rows) == odd.count() and bpe.digest(odd.limit(0), VOCABULARY).collect() == []
    nothing = sha256(b"").hexdigest()
    got = by_id(bpe.digest(odd.filter("doc_id < 3"), VOCABULARY), "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == {i: ({2: len(PEER.encode_ordinary(" \n\t "))}.get(i, 0),) + (
        (nothing, nothing) if i < 2 else (sha256(",".join(map(str, PEER.encode_ordinary(" \n\t "))).encode()).hexdigest(),
                                          sha256(b" \n\t ").hexdigest())) for i in range(3)}
    trip = bpe.round_trip(odd, VOCABULARY)
    assert all(r["same"] for r in trip.collect())


def test_fold_and_helper_agree(spark):
    """The higher-order fold, the helper and the library, piece by piece."""
    rng = random.Random(7)
    words = ["".join(rng.choices("thionernaéß", k=rng.randint(1, 14))) for _ in range(200)] + ["a" * 30, "日本語", "x"]
    got = spark.createDataFrame([(w,) for w in words], "piece string").select(
        "piece", bpe.folded(F.col("piece"), VOCABULARY).alias("ids")).collect()
    for r in got:
        assert r["ids"] == bpe.merged(r["piece"].encode(), VOCABULARY.first, VOCABULARY.pairs) == PEER._encode_single_piece(r["piece"])


def test_ids_column_is_replaced(documents):
    docs = documents([(1, "the end")]).withColumnRenamed("size", "ids")
    assert by_id(bpe.encode(docs, VOCABULARY), "ids") == {1: (PEER.encode_ordinary("the end"),)}


def test_frequent_pieces_in_whole_classes(spark):
    """The most frequent come first, at most as many as asked for; a class that does not fit is left out whole."""
    counts = {"a": 1000, "b": 400, "c": 40, **{f"t{i}": 7 for i in range(30)}, **{f"u{i}": 1 for i in range(50)}}
    df = spark.createDataFrame([(p,) for p, n in counts.items() for _ in range(n)], "piece string").repartition(3)
    for size, want in ((0, 0), (2, 2), (3, 3), (20, 3), (33, 33), (80, 33), (1000, 83)):
        got = {r["piece"] for r in bpe.frequent(df, size).collect()}
        assert len(got) == want and got == set(sorted(counts, key=lambda p: -counts[p])[:want])
    assert bpe.frequent(df.limit(0), 5).collect() == []


def test_pieces_merge_together(monkeypatch):
    """Pieces of all lengths, merged many at a time, are the library's; only those beyond the widest class one by one."""
    rng = random.Random(11)
    alphabet = "thionernaéß日\U0001F600 0\0"
    pieces = ["".join(rng.choices(alphabet, k=rng.randint(1, 30))) for _ in range(400)] + ["a" * n for n in range(1, 70)]
    pieces += ["", "x", "ab" * 100]
    alone, plain = [], bpe.merged
    monkeypatch.setattr(bpe, "merged", lambda piece, *more: alone.append(piece) or plain(piece, *more))
    merges = bpe.Merges(VOCABULARY.first, VOCABULARY.pairs)
    for mine in (pieces, pieces[:1], []):
        for cut in (0, 1):
            order, ids = merges.all(pa.array(["before"] * cut + mine, pa.string()).slice(cut))
            got = dict(zip(order.tolist(), ids.to_pylist()))
            assert got == {k: plain(p.encode(), VOCABULARY.first, VOCABULARY.pairs) for k, p in enumerate(mine)}
            assert all(got[k] == PEER._encode_single_piece(p) for k, p in enumerate(mine) if p)
    assert sorted(set(alone)) == sorted({p.encode() for p in pieces if len(p.encode()) > bpe.WIDTHS[-1]})


def test_round_trip_whatever_the_dictionary_holds(documents):
    """Null and repeated texts too."""
    rows = [(i, t) for i, t in enumerate(texts() * 3)] + [(None, None)]
    for size in (0, 5):
        got = bpe.round_trip(documents(rows), VOCABULARY, size=size).collect()
        assert all(r["same"] for r in got) and {r["doc_id"]: tuple(r["ids"]) for r in got} == {
            i: tuple(PEER.encode_ordinary(t or "")) for i, t in rows}
        assert all(r["n_tokens"] == len(r["ids"]) for r in got)
