"""Repeated passages across documents, by suffix arrays over shards of text.

Which bytes of a document lie in a string of LENGTH bytes that also starts in a
document with a smaller id? All of them, in an exact copy; copies are told by a
hash first. For the others four steps, each over whole shards of text:

1. Documents are packed into shards. Each string of LENGTH bytes has one anchor, the
   GRAM-byte piece inside it with the smallest hash; strings that follow each
   other mostly share theirs. A shard sends the hashes of its anchors, each once,
   to parts cut by hash.
2. A part returns to each shard those of its anchors that some other document has
   as well. A string whose anchor is in one document only can't repeat.
3. A shard sends the stretches of text around its shared anchors, equal ones
   once, to the part of the anchor. An anchor with very many occurrences would fill
   its part with stretches that differ around it; its strings are dealt one by one.
4. A part takes equal stretches together. Different ones can only have a string in
   common if their anchor is the same. For those it builds a suffix array for the
   stretches of each few shards (Larsson and Sadakane's refinement, common prefixes
   by Kasai's rule), takes from it the distinct strings in order, and merges these
   lists by binary search. So it knows the smallest id with each string, and
   answers the shards.

Hashes only route; strings meet as bytes. Work is linear in the text, parts and
shards have bounded size, and whatever a hot passage or copied document repeats
is sent once by each shard.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import small_or_not, stash, stash_by

LENGTH, GRAM = 50, 24  # GRAM in whole words of 8 bytes; shorter ones are shared by chance ever more as the text grows
#: Bytes that the suffix array's rounds have compared when what is still tied can only be told apart further on.
PROVED = 32
IN_WINDOW = LENGTH - GRAM + 1
SHARD_BYTES, CHUNK_BYTES = 12 << 20, 1 << 16
#: Text for which one more part is made.
PART_BYTES = 8 << 20
SAMPLE_ROWS, SAMPLE_BYTES = 400, 1_000_000
#: Compression of stretches, and of the shards' own text.
PIECES_LEVEL, BODY_LEVEL = 5, 4
#: Occurrences, added up over shards, from which an anchor is hot: so many stretches, if they all differ, are a small
#: part of a part.
HOT = 32768
#: Stretches of so many bytes together get one suffix array.
BLOCK_BYTES = 1 << 19
#: Stands for a null id: larger than any, so that it never counts as smaller.
NO_ID = np.iinfo("int64").max
#: Bits of an anchor's hash that tell it from others in its part, besides those that choose the part. An anchor taken
#: for another costs a stretch sent in vain.
KEY_BITS = 28
M1, *GRAM_M = (np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))
#: Copies up to which they are broadcast, some 130 bytes each in memory, so that no texts are shuffled.
COPIES = 1_000_000
#: Goes in which a shard takes its replies: of many parts each has little.
GOES = 16


def packed(*arrays: np.ndarray, level: int = 3) -> bytes:
    """Arrays in one compressed piece of bytes."""
    raw = [a.tobytes() for a in arrays]
    return zstandard.compress(struct.pack(f"<{len(raw)}q", *map(len, raw)) + b"".join(raw), level)


def unpacked(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.decompress(data)
    sizes = struct.unpack_from(f"<{len(kinds)}q", raw)
    ends = np.cumsum([8 * len(kinds), *sizes])
    return [np.frombuffer(raw, kind, (b - a) // np.dtype(kind).itemsize, a)
            for kind, a, b in zip(kinds, ends[:-1], ends[1:])]


class Squeeze:
    """Compresses short pieces of text, with a sample of the corpus to refer back to."""

    def __init__(self, sample: bytes):
        known = zstandard.ZstdCompressionDict(sample, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if sample else None
        if known:
            known.precompute_compress(level=PIECES_LEVEL)
        self.press = zstandard.ZstdCompressor(dict_data=known) if known else zstandard.ZstdCompressor(PIECES_LEVEL)
        self.back = zstandard.ZstdDecompressor(known)


def noted(piece: np.ndarray, low: np.ndarray, size: np.ndarray) -> bytes:
    """Where a shard has the stretches it sends to a part, in few bytes.

    Stretches are numbered as they first occur, so a new one needs no number
    and one seen before only how far back its number is.
    """
    next_new = np.append(0, np.maximum.accumulate(piece) + 1)[: len(piece)]
    back = np.where(piece == next_new, 0, next_new - piece)
    return packed(back.astype("uint32"), np.diff(low, prepend=0).astype("int32"), size.astype("uint8"))


def occurrences(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, low, size) as they were noted."""
    back, step, size = unpacked(blob, "uint32", "int32", "uint8")
    fresh = back == 0
    return np.cumsum(fresh) - fresh - back, np.cumsum(step, dtype="int64"), size.astype("int64")


def words_at(body: np.ndarray, order: str = "<") -> np.ndarray:
    """The 8 bytes from each position on as one number; zeros follow the end."""
    padded = np.concatenate([body, np.zeros(16, "uint8")])
    out = np.empty(len(body) // 8 * 8 + 8, "uint64")
    for r in range(8):
        out[r::8] = padded[r: r + len(out)].view(order + "u8")[: len(out) // 8]
    return out[: len(body)]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * M1
    return x ^ (x >> np.uint64(29))


def hashed(words: list[np.ndarray]) -> np.ndarray:
    """Hashes of GRAM bytes, from their words."""
    return mixed(sum(w * m for w, m in zip(words, GRAM_M, strict=True)))


def stretches(body: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings with the same anchor: first start, how many starts, hash of the anchor, bytes of the run before it.

    ``ends`` are the document ends in ``body``; no string crosses one.
    """
    lows, sizes, hashes, leads = [], [], [], []
    for a in range(0, max(len(body) - LENGTH + 1, 0), CHUNK_BYTES):
        piece = body[a: a + CHUNK_BYTES + LENGTH - 1]
        grams = len(piece) - GRAM + 1
        w = words_at(piece)
        gram = hashed([w[k: k + grams] for k in range(0, GRAM, 8)])
        mask = np.uint64((1 << 22) - 1)
        least = (gram & ~mask) | (mask - np.arange(grams, dtype="uint64"))  # of equal grams the last one
        span = 1
        while 2 * span <= IN_WINDOW:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < IN_WINDOW:
            least = np.minimum(least[: len(least) - (IN_WINDOW - span)], least[IN_WINDOW - span:])
        anchor = (mask - (least & mask)).astype("int64")
        whole = np.ones(len(anchor), bool)
        first, last = np.searchsorted(ends, (a + 1, a + len(anchor) + LENGTH))
        for end in (ends[first:last] - a).tolist():
            whole[max(end - LENGTH + 1, 0): end] = False
        fresh = np.ones(len(anchor), bool)
        fresh[1:] = (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1])
        at = np.flatnonzero(fresh)
        count = np.diff(np.append(at, len(anchor)))
        good = whole[at]
        lows.append(at[good] + a)
        sizes.append(count[good])
        hashes.append(gram[anchor[at[good]]])
        leads.append(anchor[at[good]] - at[good])
    if not lows:
        return np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0, "uint64"), np.zeros(0, "int64")
    return np.concatenate(lows), np.concatenate(sizes), np.concatenate(hashes), np.concatenate(leads)


def suffix_array(body: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions in the order of the text from them on; and which share PROVED bytes with the one before, at least.

    Each round orders what is still tied after h bytes by the ranks of the
    positions h further on, which doubles h; what is alone in its rank is done.
    """
    n = len(body)
    first = words_at(body, ">")
    order = np.argsort(first)
    ranked = first[order]
    head = np.ones(n, bool)
    head[1:] = ranked[1:] != ranked[:-1]
    rank = np.empty(n, "int64")
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    places, h, close = np.arange(n), 8, None
    while True:
        if h == PROVED:
            close = ~head
        alone = head[places] & np.append(head, True)[places + 1]
        places = places[~alone]
        if not len(places):
            if close is None:
                return order, np.zeros(n, bool)
            # Near the end the zeros after it may have stood for text.
            whole = order + PROVED <= n
            return order, close & whole & np.append(True, whole[:-1])
        at = order[places]
        beyond = at + h
        # Past the end the shorter text comes first.
        key = (rank[at] << 32) + np.where(beyond < n, rank[np.minimum(beyond, n - 1)] + 1, n - beyond)
        by = np.argsort(key)
        at, key = at[by], key[by]
        order[places] = at
        fresh = np.ones(len(at), bool)
        fresh[1:] = key[1:] != key[:-1]
        head[places] = fresh
        rank[at] = np.maximum.accumulate(np.where(fresh, places, 0))
        h *= 2


def common_prefixes(body: np.ndarray, order: np.ndarray, most: int, close: np.ndarray | None = None) -> np.ndarray:
    """Bytes in common, up to ``most``, of each place of the order with the place before it.

    With ``close`` from the suffix array, places that share less than PROVED bytes are given as 0.

    Kasai's rule: one position further on, the common prefix with the
    predecessor is at most one shorter. Positions are taken in strides, coarse
    to fine, each starting from what a neighbour to the left has proved.
    """
    n = len(body)
    words = np.append(words_at(body), np.zeros(1, "uint64"))
    before = np.empty(n, "int64")
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    least = np.zeros(n, "int64")
    wanted = before >= 0
    if close is not None:
        wanted[order] = close
        least[wanted] = PROVED
    found = least.copy()
    stride = 16
    todo = np.arange(0, n, stride)
    while True:
        here = todo[wanted[todo] & (found[todo] < most)]
        while len(here):
            other, known = before[here], found[here]
            room = np.minimum(n - np.maximum(here, other), most) - known
            differ = words[np.minimum(here + known, n)] ^ words[np.minimum(other + known, n)]
            low = np.maximum(differ & (~differ + np.uint64(1)), np.uint64(1))
            same = np.where(differ == 0, 8, np.log2(low.astype("float64")).astype("int64") // 8)
            found[here] = known + np.minimum(same, np.maximum(room, 0))
            here = here[(same == 8) & (room > 8)]
        if stride == 1:
            return found[order]
        stride //= 2
        todo = np.arange(stride, n, 2 * stride)
        found[todo] = np.where(wanted[todo], np.maximum(found[todo - stride] - stride, least[todo]), 0)


def distinct_strings(pieces: list[bytes], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct strings of the pieces in order, the smallest id of each, and each start's place among them."""
    body = np.frombuffer(b"".join(pieces), "uint8")
    sizes = np.array([len(p) for p in pieces])
    order, close = suffix_array(body)
    prefix = common_prefixes(body, order, LENGTH, close)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(body))
    starts = left[order] >= LENGTH
    # A string goes on from start to start as long as no prefix on the way is shorter.
    group = np.cumsum(prefix < LENGTH)[starts]
    at = order[starts]
    fresh = np.ones(len(at), bool)
    fresh[1:] = group[1:] != group[:-1]
    number = np.cumsum(fresh) - 1
    least = np.minimum.reduceat(np.repeat(ids, sizes)[at], np.flatnonzero(fresh))
    spans = np.lib.stride_tricks.sliding_window_view(body, LENGTH)[at[fresh]]
    by_place = np.full(len(body), -1)
    by_place[at] = number
    return np.ascontiguousarray(spans).view(f"S{LENGTH}").ravel(), least, by_place[left >= LENGTH]


def merged(blocks: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Sorted lists of strings with ids as one, with the smallest id of each string, by binary search.

    Halves first, so that a string is copied once for each doubling. Also where each list's strings have come to be.
    """
    if len(blocks) == 1:
        return *blocks[0], [np.arange(len(blocks[0][0]))]
    half = len(blocks) // 2
    (strings, ids, places), (more, their, others) = merged(blocks[:half]), merged(blocks[half:])
    at = np.searchsorted(strings, more)
    held = at < len(strings)
    held[held] = strings[at[held]] == more[held]
    old = np.ones(len(strings) + np.count_nonzero(~held), bool)
    fresh = at[~held] + np.arange(len(old) - len(strings))
    old[fresh] = False
    old = np.flatnonzero(old)
    new = np.empty(len(more), "int64")
    new[held], new[~held] = old[at[held]], fresh
    out, best = np.empty(len(old) + len(fresh), strings.dtype), np.full(len(old) + len(fresh), NO_ID)
    out[old], out[fresh] = strings, more[~held]
    best[old] = ids
    best[new] = np.minimum(best[new], their)
    return out, best, [old[p] for p in places] + [new[p] for p in others]


def pack(parts: int) -> object:
    """Documents to shards, and of each shard its anchors by part."""
    def emit(rows: list[tuple]) -> pd.DataFrame:
        texts = [t for _, t in rows]
        ids = np.array([NO_ID if i is None else i for i, _ in rows], "int64")
        ends = np.cumsum([len(t) for t in texts])
        body = np.frombuffer(b"".join(texts), "uint8")
        shard = uuid.uuid4().int >> 65
        out = [(shard, None, packed(body, ids, ends, level=BODY_LEVEL), None)]
        low, _, gram, _ = stretches(body, ends)
        owner = np.searchsorted(ends, low, side="right")
        code = codes(gram, parts)
        by = np.argsort(code, kind="stable")
        code, owner = code[by], owner[by]
        first = np.flatnonzero(np.append(True, code[1:] != code[:-1])[: len(code)])
        count = np.diff(np.append(first, len(code)))
        many = np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first) if len(first) else first > 0
        code, count = code[first], np.minimum(count, 65535)
        part = code >> KEY_BITS
        cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1])[: len(part)])
        step = np.diff(code, prepend=0)
        step[cuts] = code[cuts] - (part[cuts] << KEY_BITS)
        step, count = step.astype("uint32"), count.astype("uint16")
        for a, b in zip(cuts, np.append(cuts[1:], len(part))):
            out.append((shard, part[a], None, packed(step[a:b], count[a:b], many[a:b])))
        return pd.DataFrame(out, columns=["shard", "part", "body", "blob"]).astype({"part": "Int64"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, size = [], 0
        for pdf in batches:
            for i, t in zip(pdf["doc_id"], pdf["text"]):
                text = (t or "").encode()
                rows.append((None if pd.isna(i) else int(i), text))
                size += len(text)
                if size >= SHARD_BYTES:
                    yield emit(rows)
                    rows, size = [], 0
        if rows:
            yield emit(rows)
    return run


def codes(gram: np.ndarray, parts: int) -> np.ndarray:
    """Part of an anchor and KEY_BITS of its hash, as one number."""
    key = gram & np.uint64((1 << KEY_BITS) - 1)
    return ((gram >> np.uint64(KEY_BITS)) % np.uint64(parts)).astype("int64") << KEY_BITS | key.astype("int64")


def in_common(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each shard its anchors, of one part, that several documents have; and which are hot."""
    keys, counts, many = [], [], []
    for blob in pdf["blob"]:
        step, n, m = unpacked(blob, "uint32", "uint16", "bool")
        keys.append(np.cumsum(step, dtype="int64"))
        counts.append(n)
        many.append(m)
    ends = np.cumsum([len(k) for k in keys])
    of = np.concatenate(keys)
    by = np.argsort(of)
    key, count, several = of[by], np.concatenate(counts)[by], np.concatenate(many)[by]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    size = np.diff(np.append(first, len(key)))
    # Back in the shards' own order, in which each has one run.
    shared, hot = np.empty(len(by), bool), np.empty(len(by), bool)
    shared[by] = np.repeat((size > 1) | np.logical_or.reduceat(several, first), size)
    hot[by] = np.repeat(np.add.reduceat(count, first, dtype="int64") >= HOT, size)
    start = np.array([int(pdf["part"].iloc[0]) << KEY_BITS], "int64")
    out = []
    for shard, a, b in zip(pdf["shard"], np.append(0, ends[:-1]).tolist(), ends.tolist()):
        mine = shared[a:b]
        if mine.any():
            out.append((shard, packed(start, np.diff(of[a:b][mine], prepend=0).astype("uint32"), hot[a:b][mine])))
    return pd.DataFrame(out, columns=["shard", "blob"])


def cut_out(parts: int, sample: bytes) -> object:
    """A shard's stretches around shared anchors, equal ones once, by part; with each part where they occur."""
    def run(bodies: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        columns = ["shard", "part", "blob", "notes"]
        squeeze = Squeeze(sample)
        if not len(wanted) or not len(bodies):
            return pd.DataFrame(columns=columns).astype({"shard": "int64", "part": "int64"})
        shard = int(bodies["shard"].iloc[0])
        body, ids, ends = unpacked(bodies["body"].iloc[0], "uint8", "int64", "int64")
        lists = [unpacked(b, "int64", "uint32", "bool") for b in wanted["blob"]]
        codes_in = np.concatenate([start + np.cumsum(step, dtype="int64") for start, step, _ in lists])
        hot_in = np.concatenate([hot for *_, hot in lists])
        by = np.argsort(codes_in)
        codes_in, hot_in = codes_in[by], hot_in[by]
        low, size, gram, lead = stretches(body, ends)
        code = codes(gram, parts)
        # Most are told by a few bits of theirs.
        bits = (1 << 22) - 1
        may = np.zeros(bits + 1, bool)
        may[codes_in & bits] = True
        some = np.flatnonzero(may[code & bits])
        at = np.minimum(np.searchsorted(codes_in, code[some]), len(codes_in) - 1)
        mine = codes_in[at] == code[some]
        some, hot = some[mine], hot_in[at[mine]]
        low, size, lead, part = low[some], size[some], lead[some], code[some] >> KEY_BITS
        del gram, code, codes_in, hot_in, may, some, at, mine  # a shard may be shared as a whole
        raw = body.tobytes()

        def numbered(low: np.ndarray, size: np.ndarray) -> tuple[list[bytes], np.ndarray]:
            """The distinct stretches as they first occur, and which of them each one is."""
            known: dict[bytes, int] = {}
            texts = map(raw.__getitem__, map(slice, low, low + size + (LENGTH - 1)))
            which = np.fromiter((known.setdefault(text, len(known)) for text in texts), "int64", len(low))
            return list(known), which

        pieces, piece = numbered(low[~hot], size[~hot])
        if hot.any():
            # The strings of each distinct stretch, once; then those of all occurrences by number.
            wide, of = numbered(low[hot], size[hot])
            count = np.empty(len(wide), "int64")
            count[of] = size[hot]
            strings = [text[k: k + LENGTH] for text in wide for k in range(len(text) - LENGTH + 1)]
            known = {text: q for q, text in enumerate(dict.fromkeys(strings), len(pieces))}
            number = np.fromiter(map(known.__getitem__, strings), "int64", len(strings))
            dealt = np.array([crc32(text) % parts for text in known], "int64")
            step = np.arange(size[hot].sum()) - np.repeat(np.cumsum(size[hot]) - size[hot], size[hot])
            each = number[np.repeat((np.cumsum(count) - count)[of], size[hot]) + step]
            low = np.append(low[~hot], np.repeat(low[hot], size[hot]) + step)
            lead = np.append(lead[~hot], np.repeat(lead[hot], size[hot]) - step)
            part = np.append(part[~hot], dealt[each - len(pieces)])
            size = np.append(size[~hot], np.ones(len(each), "int64"))
            pieces, piece = pieces + list(known), np.append(piece, each)
        by = np.argsort(part, kind="stable")
        part, piece, low, size, lead = part[by], piece[by], low[by], size[by], lead[by]
        # Numbers by first occurrence, so that those of a part follow each other.
        first = np.empty(len(pieces), "int64")
        first[piece[::-1]] = np.arange(len(piece))[::-1]
        in_order = np.argsort(first)
        number = np.empty(len(pieces), "int64")
        number[in_order] = np.arange(len(pieces))
        piece, first = number[piece], first[in_order]
        least = np.full(len(pieces), NO_ID)
        np.minimum.at(least, piece, ids[np.searchsorted(ends, low, side="right")])
        pieces = [pieces[q] for q in in_order.tolist()]
        sizes, leads = (size[first] + LENGTH - 1).astype("uint8"), lead[first].astype("uint8")
        cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1])[: len(part)])
        begins = np.searchsorted(first, cuts)
        step = np.diff(least, prepend=0)
        step[begins] = least[begins]
        out = []
        for a, b, c, d in zip(cuts.tolist(), [*cuts[1:].tolist(), len(part)], begins.tolist(), [*begins[1:].tolist(), len(pieces)]):
            text = np.frombuffer(squeeze.press.compress(b"".join(pieces[c:d])), "uint8")
            out.append((shard, int(part[a]), packed(sizes[c:d], leads[c:d], step[c:d], text),
                        noted(piece[a:b] - c, low[a:b], size[a:b])))
        return pd.DataFrame(out, columns=columns)
    return run


def may_meet(body: np.ndarray, at: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Of distinct stretches, with where their anchors are and how many strings they have: which may have one in common.

    Those whose anchor another has; but not if all these are single strings.
    """
    grams = body[at[:, None] + np.arange(GRAM)].view("uint64")
    _, of, size = np.unique(hashed(list(grams.T)), return_inverse=True, return_counts=True)
    longer = np.zeros(len(size), bool)
    longer[of[count > 1]] = True
    return ((size > 1) & longer)[of]


def answered(sample: bytes) -> object:
    """For each shard's stretches in a part: how far below the shard's own smallest id the smallest of all is.

    One number for a stretch whose strings have the same, else one for each string. A shard's own notes go back with it.
    """
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        squeeze = Squeeze(sample)
        texts, ids, leads = [], [], []
        for blob in pdf["blob"]:
            sizes, lead, step, text = unpacked(blob, "uint8", "uint8", "int64", "uint8")
            text, end = squeeze.back.decompress(text.tobytes()), np.cumsum(sizes, dtype="int64")
            texts.append([text[a:b] for a, b in zip((end - sizes).tolist(), end.tolist())])
            leads.append(lead)
            ids.append(np.cumsum(step))
        ends = np.cumsum([len(i) for i in ids]).tolist()
        held, leads = np.concatenate(ids), np.concatenate(leads)
        known = {text: q for q, text in enumerate(dict.fromkeys(chain.from_iterable(texts)))}
        mine = np.fromiter(map(known.__getitem__, chain.from_iterable(texts)), "int64", len(held))
        pieces = list(known)
        del known, texts
        least = np.full(len(pieces), NO_ID)
        np.minimum.at(least, mine, held)
        lead = np.empty(len(pieces), "int64")
        lead[mine] = leads
        sizes = np.array([len(p) for p in pieces])
        count = sizes - LENGTH + 1
        body = np.frombuffer(b"".join(pieces), "uint8")
        meet = np.flatnonzero(may_meet(body, np.cumsum(sizes) - sizes + lead, count))
        # Of the others all strings are where the stretch is.
        low, high, first = least.copy(), least.copy(), np.zeros(len(pieces), "int64")
        by_start = np.zeros(0, "int64")
        if len(meet):
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes[meet]) // BLOCK_BYTES)) + 1
            blocks = [distinct_strings([pieces[q] for q in at.tolist()], least[at]) for at in np.split(meet, cuts)]
            _, best, places = merged([(s, i) for s, i, _ in blocks])
            by_start = np.concatenate([best[at][number] for at, (*_, number) in zip(places, blocks)])
            start = np.cumsum(count[meet]) - count[meet]
            first[meet] = start
            low[meet], high[meet] = np.minimum.reduceat(by_start, start), np.maximum.reduceat(by_start, start)
        even = (low == high)[mine]
        odd = mine[~even]
        n = count[odd]
        at = np.repeat(first[odd] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        below, each = (held - low[mine])[even], np.repeat(held[~even], n) - by_start[at]
        # Where the blobs end in these.
        flat_ends = np.append(0, np.cumsum(even))[ends].tolist()
        each_ends = np.append(0, np.cumsum(np.where(even, 0, count[mine])))[ends].tolist()
        cuts = [[slice(a, b) for a, b in zip([0, *to], to)] for to in (ends, flat_ends, each_ends)]
        return pd.DataFrame([
            (shard, packed(even[a], below[b], each[c]), notes)
            for shard, notes, a, b, c in zip(pdf["shard"], pdf["notes"], *cuts)], columns=["shard", "blob", "notes"])
    return run


def repeats(told: list[tuple[bytes, bytes]], ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From replies and the notes on what they are for: from where to where smaller ids have the same."""
    replies, places, before = [], [], 0
    for reply, notes in told:
        replies.append(unpacked(reply, "bool", "int64", "int64"))
        piece, low, size = occurrences(notes)
        places.append((piece + before, low, size))
        before += len(replies[-1][0])
    even, below, each = map(np.concatenate, zip(*replies))
    piece, low, size = map(np.concatenate, zip(*places))
    mine = ids[np.searchsorted(ends, low, side="right")]
    own = np.full(before, NO_ID)
    np.minimum.at(own, piece, mine)
    # One number for all strings of a stretch.
    least = own.copy()
    least[even] -= below
    flat = even[piece]
    smaller = flat & (least[piece] < mine)
    starts, stops = low[smaller], low[smaller] + size[smaller] + LENGTH - 1
    # One for each string.
    odd = ~flat
    count = np.zeros(before, "int64")
    count[piece[odd]] = size[odd]
    least = np.repeat(own, count) - each
    n = size[odd]
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    smaller = least[np.repeat((np.cumsum(count) - count)[piece[odd]], n) + step] < np.repeat(mine[odd], n)
    start = (np.repeat(low[odd], n) + step)[smaller]
    return np.append(starts, start), np.append(stops, start + LENGTH)


def finished(bodies: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
    """Every document of a shard without what smaller ids have."""
    out = []
    for whole in bodies["body"]:
        body, ids, ends = unpacked(whole, "uint8", "int64", "int64")
        gone = np.zeros(len(body) + 1, "int8")  # over a byte lie LENGTH strings at most
        every = len(told) // GOES + 1
        for a in range(0, len(told), every):
            starts, stops = repeats(list(zip(told["blob"][a: a + every], told["notes"][a: a + every])), ids, ends)
            np.add.at(gone, starts, 1)
            np.add.at(gone, stops, -1)
        covered = np.cumsum(gone, dtype="int8", out=gone)[:-1] > 0
        for i, a, b in zip(ids.tolist(), [0, *ends[:-1].tolist()], ends.tolist()):
            mine = covered[a:b]
            n = int(mine.sum())
            spans = int(np.count_nonzero(mine[1:] & ~mine[:-1]) + mine[0]) if n else 0
            kept = body[a:b][~mine].tobytes() if n else body[a:b].tobytes()
            out.append((None if i == NO_ID else i, b - a, n, spans, kept))
    return pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]).astype({"doc_id": "Int64"})


def without_repeats(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (the bytes that stay).

    Null texts are empty. A null id counts as larger than any other, equal ids
    are not smaller than each other: repeated rows don't remove each other.
    Texts shorter than LENGTH stay whole. An empty table gives no rows. Other
    columns are ignored. Ids must be below the largest long.
    """
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.unhex(F.substring(
        F.sha2(F.col("text").cast("binary"), 256), 1, 32)).alias("same"))
    keys = texts.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH)).select("doc_id", "same")
    firsts = keys.groupBy("same").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    copies = stash(keys.join(firsts, "same").filter("doc_id > first").select("doc_id", "same").distinct(), "copies")
    copies = small_or_not(copies, COPIES)

    rest = texts.join(copies, ["doc_id", "same"], "left_anti").select("doc_id", "text")
    n = F.octet_length("text").cast("long").alias("n")
    whole = texts.select("doc_id", "same", n).join(copies, ["doc_id", "same"], "left_semi").select(
        "doc_id", F.col("n").alias("n_bytes"), F.col("n").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
        F.lit("").cast("binary").alias("kept"))

    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // PART_BYTES))
    # Only an aid to compression: any pieces of text do, and they need not be many.
    some = texts.select(F.substring("text", 1, SAMPLE_BYTES // SAMPLE_ROWS).alias("text")).filter("text IS NOT NULL")
    sample = "".join(r["text"] for r in some.limit(SAMPLE_ROWS).collect()).encode()
    shards = stash_by(rest.mapInPandas(pack(parts), "shard long, part long, body binary, blob binary"), "shard",
                      -(-total // SHARD_BYTES), "shards")
    bodies = shards.filter("body IS NOT NULL").select("shard", "body").groupBy("shard")
    wanted = shards.filter("part IS NOT NULL").select("shard", "part", "blob").groupBy("part").applyInPandas(
        in_common, "shard long, blob binary")
    pieces = bodies.cogroup(wanted.groupBy("shard")).applyInPandas(
        cut_out(parts, sample), "shard long, part long, blob binary, notes binary")
    told = pieces.groupBy("part").applyInPandas(answered(sample), "shard long, blob binary, notes binary").groupBy("shard")
    return bodies.cogroup(told).applyInPandas(
        finished, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary").union(whole)


def digest(documents: DataFrame) -> DataFrame:
    return without_repeats(documents).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
