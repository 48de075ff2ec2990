"""Byte-level BPE: merges folded by higher-order functions, once for each frequent word.

Text is split by the tokenizer's pattern and each piece is encoded by itself.
The DICTIONARY most frequent distinct pieces of the corpus are encoded by Spark: a
higher-order function folds merges over the piece's bytes, each time of the
neighbouring pair of lowest rank, leftmost first, found in a literal rank map. The
dictionary is bounded, so it can be sent to all tasks, which put the ids of a batch of texts together from it.
Pieces outside it are merged in the task that meets them, all those of a batch at once, by the
same rule; the result does not depend on what the dictionary holds.
Decoding looks ids up and concatenates their bytes.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import let, literal, stash, text_of

#: Fixed by the tokenizer: the pattern that cuts text into pieces. White space is Unicode's.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{IsWhite_Space}\p{L}\p{N}]+"
           r"|\p{IsWhite_Space}+(?!\P{IsWhite_Space})|\p{IsWhite_Space}+")
DICTIONARY = 100_000
#: Most bytes of the pieces that are merged together; longer ones are merged one by one. No wider than PLACE bits tell apart.
WIDTHS, PLACE = (4, 6, 8, 10, 12, 16, 24, 32, 64), 6
#: Classes of counts for each power of two, and tasks that fold the merges of the dictionary.
STEPS, FOLDING = 16, 48
SLOTS = 1 << 16
NO_RANK, NO_TOKEN = 2**31 - 1, 1 << 16
Pairs = dict[tuple[int, int], int]


class Vocabulary:
    """Tokens by rank, ranks below 65,536, and the rank of each pair of tokens that make a token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.first = [ranks[bytes([b])] for b in range(256)]
        self.pairs: Pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    self.pairs[a, b] = rank
        #: Whole pieces that are a token although merges of their bytes do not lead there.
        self.unreached = {t: [r] for t, r in ranks.items() if merged(t, self.first, self.pairs) != [r]}


def read_vocabulary(path: str) -> Vocabulary:
    """From a file of lines with a base64 token and its rank."""
    with open(path, "rb") as lines:
        return Vocabulary({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})


def merged(piece: bytes, first: list[int], pairs: Pairs) -> list[int]:
    """Ids of a piece: the leftmost pair of the lowest rank merges, again and again."""
    ids = [first[b] for b in piece]
    ranks = [pairs.get(p, NO_RANK) for p in zip(ids, ids[1:])]
    while ranks and (lowest := min(ranks)) < NO_RANK:
        i = ranks.index(lowest)
        while True:
            ids[i:i + 2] = [lowest]
            del ranks[i]
            left = right = NO_RANK
            if i:
                left = ranks[i - 1] = pairs.get((ids[i - 1], lowest), NO_RANK)
            if i < len(ranks):
                right = ranks[i] = pairs.get((lowest, ids[i + 1]), NO_RANK)
            # Unless the merge made a pair that comes first, go on to the next one of this rank.
            if left <= lowest or right < lowest or lowest not in ranks:
                break
            i = ranks.index(lowest, i)
    return ids


class Merges:
    """Merges pieces, many at a time, by the rule of ``merged``."""

    def __init__(self, first: list[int], pairs: Pairs):
        keys = np.array([a << 16 | b for a, b in pairs], "uint32")
        by = np.argsort(keys)
        # One that no pair has, so that there always is a last one.
        self.keys = np.append(keys[by], np.uint32(2**32 - 1))
        self.ranks = np.append(np.array(list(pairs.values()), "int32")[by], np.int32(NO_TOKEN))
        self.first = np.array(first, "int32")
        self.of_bytes = self.rank(np.repeat(self.first, 256), np.tile(self.first, 256))

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of tokens, NO_TOKEN where they do not merge or there is no second."""
        key = a.astype("uint32") << np.uint32(16) | b.astype("uint32")
        at = np.searchsorted(self.keys, key)
        return np.where((self.keys[at] == key) & (b >= 0), self.ranks[at], np.int32(NO_TOKEN))

    def short(self, body: np.ndarray, start: np.ndarray, size: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of at most ``width`` bytes, one after the other, and how many each has.

        A column for each piece; in each round every piece left merges its
        leftmost pair of the lowest rank, so all are one shorter after it.
        """
        place = np.arange(width, dtype="int32")[:, None]
        inside = place < size
        raw = np.where(inside, body[np.minimum(start + place, len(body) - 1)], 0)
        ids = np.where(inside, self.first[raw], np.int32(-1))
        ranks = np.where(inside[1:], self.of_bytes[raw[:-1].astype("int32") * 256 + raw[1:]], np.int32(NO_TOKEN))
        out, left = np.full((width, len(size)), -1, "int32"), np.arange(len(size))
        while len(left):
            lowest = np.full(len(left), NO_TOKEN << PLACE, "int32")
            if len(ranks):
                lowest = (ranks << PLACE | place[: len(ranks)]).min(axis=0)
            done = lowest >= NO_TOKEN << PLACE
            if done.any():
                out[: len(ids), left[done]] = ids[:, done]
                left, ids, ranks, lowest = left[~done], ids[:, ~done], ranks[:, ~done], lowest[~done]
            if not len(left):
                break
            at, token, here = lowest & ((1 << PLACE) - 1), lowest >> PLACE, np.arange(len(left))
            ids = np.where(place[: len(ids) - 1] > at, ids[1:], ids[:-1])
            ids[at, here] = token
            ranks = np.where(place[: len(ranks) - 1] >= at, ranks[1:], ranks[:-1])
            some = at > 0
            ranks[at[some] - 1, here[some]] = self.rank(ids[at[some] - 1, here[some]], token[some])
            some = at < len(ranks)
            ranks[at[some], here[some]] = self.rank(token[some], ids[at[some] + 1, here[some]])
        return out.T[out.T >= 0], np.count_nonzero(out >= 0, axis=0)

    def all(self, pieces: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """Ids of pieces in another order, and that order."""
        ends, body = content(pieces)
        body, size = np.frombuffer(body, "uint8"), np.diff(ends)
        order = np.argsort(size, kind="stable")
        start, size = ends[:-1][order], size[order]
        flat, counts, a = [np.zeros(0, "int32")], [np.zeros(0, "int64")], 0
        for width in WIDTHS:
            b = int(np.searchsorted(size, width, side="right"))
            if a < b:
                ids, count = self.short(body, start[a:b], size[a:b], width)
                flat.append(ids)
                counts.append(count)
                a = b
        if a < len(size):
            first = self.first.tolist()
            pairs = {(k >> 16, k & 65535): r for k, r in zip(self.keys[:-1].tolist(), self.ranks.tolist())}
            for k in range(a, len(size)):
                ids = merged(body[start[k]: start[k] + size[k]].tobytes(), first, pairs)
                flat.append(np.array(ids, "int32"))
                counts.append(np.array([len(ids)]))
        return order, lists(np.append(0, np.cumsum(np.concatenate(counts))), pa.array(np.concatenate(flat)))


def content(texts: pa.Array) -> tuple[np.ndarray, memoryview]:
    """Where the first text begins and each one ends, and the bytes that these places are in."""
    _, ends, body = texts.buffers()
    kind = "int64" if texts.type in (pa.large_string(), pa.large_binary()) else "int32"
    ends = np.frombuffer(ends or bytes(8), kind)[texts.offset: texts.offset + len(texts) + 1]
    return ends.astype("int64"), memoryview(body or b"")


def lists(ends: np.ndarray, values: pa.Array) -> pa.Array:
    """Lists of values that follow each other, from 0 and the ends of the lists."""
    return pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), values)


def pieces_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


def folded(piece: Column, vocabulary: Vocabulary) -> Column:
    """Ids of a piece by folding merges over its bytes, with the rank map as a literal hash table."""
    slots: list[list[int]] = [[] for _ in range(SLOTS)]
    for (a, b), rank_ in vocabulary.pairs.items():
        slots[(a * 40503 + b) % SLOTS].append((a << 16 | b) << 16 | rank_)
    table = literal(slots, "array<array<bigint>>")
    bytes_ = literal(vocabulary.first, "array<int>")

    def digit(code: Column) -> Column:
        return F.when(code < 58, code - 48).otherwise(code - 55)

    def first_ids(text: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.char_length(text), F.lit(2)), lambda i: F.get(
            bytes_, digit(F.ascii(F.substring(text, i, F.lit(1)))) * 16
            + digit(F.ascii(F.substring(text, i + 1, F.lit(1))))))

    def with_table(ranks: Column) -> Column:
        def rank(a: Column, b: Column) -> Column:
            pair = let(a.cast("long") * 65536 + b, lambda key: F.filter(
                F.get(ranks, (a * 40503 + b) % SLOTS), lambda v: F.shiftright(v, 16) == key))
            return F.coalesce(F.get(pair, F.lit(0)).bitwiseAND(F.lit(65535)).cast("int"), F.lit(NO_RANK))

        def start(ids: Column) -> Column:
            pairs = F.transform(F.sequence(F.lit(0), F.size(ids) - 2), lambda i: rank(F.get(ids, i), F.get(ids, i + 1)))
            return F.struct(ids.alias("ids"), F.when(F.size(ids) > 1, pairs).otherwise(
                F.array().cast("array<int>")).alias("ranks"))

        def merge(state: Column, _: Column) -> Column:
            ids, known = state["ids"], state["ranks"]

            def at(k: Column, lowest: Column) -> Column:
                n = F.size(ids)
                none = F.array().cast("array<int>")
                before = F.when(k > 1, F.array(rank(F.get(ids, k - 2), lowest))).otherwise(none)
                after = F.when(k + 1 < n, F.array(rank(lowest, F.get(ids, k + 1)))).otherwise(none)
                return F.struct(
                    F.concat(F.slice(ids, F.lit(1), k - 1), F.array(lowest), F.slice(ids, k + 2, n)).alias("ids"),
                    F.concat(F.slice(known, F.lit(1), F.greatest(k - 2, F.lit(0))), before, after,
                             F.slice(known, k + 2, n)).alias("ranks"))

            return let(F.array_min(known), lambda lowest: F.when(
                F.coalesce(lowest, F.lit(NO_RANK)) < NO_RANK,
                let(F.array_position(known, lowest).cast("int"), lambda k: at(k, lowest))).otherwise(state))

        ids = let(F.hex(piece.cast("binary")), first_ids)
        return let(ids, lambda x: F.aggregate(F.sequence(F.lit(1), F.size(x)), start(x), merge)["ids"])

    return let(table, with_table)


def frequent(pieces: DataFrame, size: int) -> DataFrame:
    """The most frequent pieces, at most ``size`` of them.

    Counts fall into STEPS classes for each power of two; the driver sees how many
    pieces each class has, and takes whole classes from the top down. So no
    task sorts or receives more than its share.
    """
    counts = stash(pieces.groupBy("piece").agg(F.count("*").alias("n")).withColumn(
        "often", F.floor(F.log2("n") * STEPS).cast("int")), "pieces")
    least, held = None, 0
    for r in sorted(counts.groupBy("often").count().collect(), reverse=True):
        held += r["count"]
        if held > size:
            break
        least = r["often"]
    return counts.filter(F.lit(False) if least is None else F.col("often") >= least).select("piece")


def dictionary(pieces: DataFrame, vocabulary: Vocabulary, size: int = DICTIONARY) -> dict[str, list[int]]:
    """Ids of the most frequent of all pieces (column ``piece``), at most ``size``."""
    # Written first, so that the plan with the literal map is one stage and is described to listeners once.
    top = stash(frequent(pieces, size).repartition(FOLDING, "piece"), "frequent")
    coded = top.select("piece", folded(F.col("piece"), vocabulary).alias("ids")).toArrow()
    known = dict(zip(coded["piece"].to_pylist(), coded["ids"].to_pylist()))
    return known | {p.decode(): ids for p, ids in vocabulary.unreached.items() if p.decode(errors="ignore").encode() == p}


class Coded:
    """Ids of a batch of texts: of each distinct piece, and which pieces the texts have."""

    def __init__(self, ids: pa.Array, entry: np.ndarray, ends: np.ndarray):
        self.ids, self.entry, self.ends = ids, pa.array(entry), ends
        count = np.diff(ids.offsets.to_numpy())
        #: 0 and where the ids of each text end.
        self.token_ends = np.append(0, np.cumsum(count[entry]))[ends]

    def of_texts(self) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(self.token_ends, pa.int32()), self.ids.take(self.entry).flatten())

    def joined(self, names: pa.Array, between: bytes) -> pa.Array:
        """Names of each text's ids, put together by piece first."""
        between = pa.scalar(between, names.type)
        by_piece = pc.binary_join(lists(self.ids.offsets.to_numpy(), names.take(self.ids.flatten())), between)
        return pc.binary_join(lists(self.ends, by_piece.take(self.entry)), between)


class Encoder:
    """Gives each task's function from texts' pieces to ids."""

    def __init__(self, documents: DataFrame, vocabulary: Vocabulary, text: str, size: int):
        pieces = documents.select(F.explode(pieces_of(text_of(text))).alias("piece"))
        known = dictionary(pieces, vocabulary, size)
        merges = Merges(vocabulary.first, vocabulary.pairs)
        # Plain arrays, as they need not be built again in each task.
        self.sent = documents.sparkSession.sparkContext.broadcast((
            pa.array(list(known), pa.string()), pa.array(list(known.values()), pa.large_list(pa.int32())),
            vars(merges), pa.array(vocabulary.tokens, pa.large_binary())))

    def function(self):
        sent = self.sent

        def start():
            known, known_ids, arrays, tokens = sent.value
            merges = Merges.__new__(Merges)
            vars(merges).update(arrays)

            def coded(pieces: pa.Array) -> Coded:
                ends = pieces.offsets.to_numpy().astype("int64")
                distinct = pieces.flatten().dictionary_encode()
                at = pc.fill_null(pc.index_in(distinct.dictionary, value_set=known), -1).to_numpy()
                rare = np.flatnonzero(at < 0)
                order, ids = merges.all(distinct.dictionary.take(pa.array(rare)))
                entry = at.astype("int64")
                entry[rare[order]] = len(known) + np.arange(len(rare))
                # Only entries that this batch has.
                mine = np.concatenate([at[at >= 0], entry[rare]])
                place = np.empty(len(entry), "int64")
                place[np.append(np.flatnonzero(at >= 0), rare)] = np.arange(len(entry))
                held = pa.concat_arrays([known_ids, ids]).take(pa.array(mine))
                return Coded(held, place[distinct.indices.to_numpy()], ends - ends[0])

            return coded, tokens
        return start


def encoded(documents: DataFrame, vocabulary: Vocabulary, text: str, size: int) -> Column:
    """Column of token ids."""
    function = Encoder(documents, vocabulary, text, size).function()

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coded, _ = function()
        for pieces in batches:
            yield coded(pieces).of_texts()

    return run(pieces_of(text_of(text)))


def decoded(ids: Column, vocabulary: Vocabulary) -> Column:
    """The bytes of token ids, concatenated."""
    names = literal([t.hex() for t in vocabulary.tokens], "array<string>")
    return let(names, lambda table: F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), "")))


def encode(documents: DataFrame, vocabulary: Vocabulary, text: str = "text", size: int = DICTIONARY) -> DataFrame:
    """All columns plus ``ids``, without special tokens. Null and empty texts have no ids; ``ids`` is replaced."""
    return documents.withColumn("ids", encoded(documents, vocabulary, text, size))


def decode(tokens: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """All columns plus ``bytes``, of the column ``ids``; null ids give null, unknown ids nothing."""
    return tokens.withColumn("bytes", decoded(F.col("ids"), vocabulary))


def digest(documents: DataFrame, vocabulary: Vocabulary, size: int = DICTIONARY) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256, the last of the decoded ids."""
    function = Encoder(documents, vocabulary, "text", size).function()

    def hashes(texts: pa.Array) -> list[str]:
        ends, body = content(texts)
        return [sha256(body[a:b]).hexdigest() for a, b in zip(ends.tolist(), ends[1:].tolist())]

    @F.arrow_udf("struct<n_tokens:long,ids_sha256:string,decoded_sha256:string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coded, tokens = function()
        names = pa.array([str(i).encode() for i in range(len(tokens))], pa.large_binary())
        for pieces in batches:
            ids = coded(pieces)
            yield pa.StructArray.from_arrays(
                [pa.array(np.diff(ids.token_ends)), pa.array(hashes(ids.joined(names, b",")), pa.string()),
                 pa.array(hashes(ids.joined(tokens, b"")), pa.string())], ["n_tokens", "ids_sha256", "decoded_sha256"])

    return documents.select("doc_id", run(pieces_of(text_of())).alias("d")).select("doc_id", "d.*")


def round_trip(documents: DataFrame, vocabulary: Vocabulary, text: str = "text", size: int = DICTIONARY) -> DataFrame:
    """All columns plus ``n_tokens``, ``ids`` and ``same``: whether the ids decode to the text's bytes (null as empty)."""
    function = Encoder(documents, vocabulary, text, size).function()

    @F.arrow_udf("struct<n_tokens:long,ids:array<int>,same:boolean>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        coded, tokens = function()
        for texts, pieces in batches:
            ids = coded(pieces)
            same = pc.equal(ids.joined(tokens, b""), texts.cast(pa.large_binary()))
            yield pa.StructArray.from_arrays([pa.array(np.diff(ids.token_ends)), ids.of_texts(), same],
                                             ["n_tokens", "ids", "same"])

    kept = [c for c in documents.columns if c not in ("n_tokens", "ids", "same")]
    out = documents.select(*kept, run(text_of(text), pieces_of(text_of(text))).alias("__out"))
    return out.select(*kept, "__out.*")
