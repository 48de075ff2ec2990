"""Near-duplicate documents by b-bit MinHash.

A document's set holds its distinct word shingles, each a 64-bit hash. Documents with
equal sets are one class, which has a number and is represented by its smallest id. Classes whose minima
agree on a whole band are candidates; signatures keep only the low bits of each
minimum, packed in longs, and a candidate lives on if the similarity estimated
from equal lanes, corrected for chance agreement, is not far below the
threshold. What lives on is decided on the full sets.

A bucket of m classes is not compared pair by pair. Each class x is compared with
the bucket's smallest, its pivot p, in full, which links a large group of
copies with one pair per member. What else can be linked to an x that p is not
linked to? With t = s (|x| + |y|) / (1 + s) the common elements a link at similarity s needs, a
partner y of x either shares elements outside p with it, at least t - |x & p|, or is so
small that t <= |x & p|. So partners are sought by the elements outside p, rarest
first and no more of them than the count leaves open, and among the small; the
estimate and the full sets decide. No link among the candidates is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import small_or_not, stash

WORDS = 5
LINK_PERCENT = 85
#: 24 bands of 4 minima: a pair at the threshold shares no band with a chance of 2e-8.
BANDS, BAND_ROWS = 24, 4
HASHES = BANDS * BAND_ROWS
#: Low bits kept of each minimum. The estimate's deviation at 0.85 is 0.043, so LEAST_ESTIMATE is 5.8 of them away.
BITS, LEAST_ESTIMATE = 2, 0.6
CHUNK_BYTES, CACHED_WORDS = 1 << 20, 200_000

_rng = np.random.default_rng(20)
FACTORS = _rng.integers(0, 2**63, HASHES, "uint64") << np.uint64(1) | np.uint64(1)
SHIFTS = _rng.integers(0, 2**63, HASHES, "uint64")
MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, known: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles; ``known`` holds word hashes."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.array([], "uint64")
    if len(known) > CACHED_WORDS:
        known.clear()
    new = [w for w in words if w not in known]
    for w in new:
        known[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(known.__getitem__, words), "uint64", len(words))
    n = min(WORDS, len(words))
    out = np.full(len(words) - n + 1, len(words) if n < WORDS else 0, "uint64")
    for i in range(n):
        out = mixed(out) + h[i: len(h) - n + 1 + i] * MIX
    return np.unique(mixed(out))


def chunks(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Rows in pieces of about CHUNK_BYTES characters."""
    size = pdf["text"].str.len().fillna(0).cumsum() // CHUNK_BYTES
    for _, piece in pdf.groupby(size, sort=False):
        yield piece


def signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Signatures: n_shingles, a hash of the whole set, packed low bits, band hashes."""
    known: dict[bytes, int] = {}
    for pdf in batches:
        for piece in chunks(pdf):
            sets = [shingles(t, known) for t in piece["text"]]
            sizes = np.array([len(s) for s in sets])
            full = sizes > 0
            packed = [None] * len(sets)
            bands = [None] * len(sets)
            if full.any():
                flat = np.concatenate([s for s in sets if len(s)])
                at = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                minima = np.stack([np.minimum.reduceat(flat * f + s, at) for f, s in zip(FACTORS, SHIFTS)], axis=1)
                low = (mixed(minima) & np.uint64(2**BITS - 1)).reshape(len(minima), -1, 64 // BITS)
                lanes = np.bitwise_or.reduce(low << (np.arange(64 // BITS, dtype="uint64") * np.uint64(BITS)), axis=2)
                grouped = minima.reshape(len(minima), BANDS, BAND_ROWS)
                band = np.broadcast_to(np.arange(BANDS, dtype="uint64") * MIX, grouped.shape[:2])
                for r in range(BAND_ROWS):
                    band = mixed(band + grouped[:, :, r])
                for i, k in enumerate(np.flatnonzero(full)):
                    packed[k], bands[k] = lanes[i].view("int64"), band[i].view("int64")
            yield pd.DataFrame({
                "doc_id": piece["doc_id"], "n_shingles": sizes,
                "set_hash": [hash_of(s) if len(s) else None for s in sets],
                "sig": packed, "bands": bands})


def hash_of(items: np.ndarray) -> bytes:
    return blake2b(items.tobytes(), digest_size=16).digest()


def gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Full shingle sets of classes, from rows of their representatives; rows of an id with another text are left out."""
    known: dict[bytes, int] = {}
    for pdf in batches:
        for piece in chunks(pdf):
            sets = [shingles(t, known) for t in piece["text"]]
            mine = np.array([hash_of(s) == bytes(h) for s, h in zip(sets, piece["set_hash"])], bool)
            yield pd.DataFrame({"cid": piece["cid"].to_numpy()[mine], "items": pd.Series(
                [s.view("int64") for s, m in zip(sets, mine) if m], dtype=object)})


def estimate(a: Column, b: Column) -> Column:
    """Similarity from the lanes two packed signatures share, corrected for lanes that agree by chance."""
    odd = sum(1 << i for i in range(0, 64, BITS))
    odd -= (odd >> 63) << 64
    unlike = F.lit(0)
    for i in range(HASHES * BITS // 64):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        for _ in range(BITS - 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        unlike = unlike + F.bit_count(x.bitwiseAND(F.lit(odd)))
    chance = 2.0**-BITS
    return ((1 - unlike / HASHES) - chance) / (1 - chance)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node with an edge (a, b) reaches.

    Each round moves every node to the smallest neighbour of its smallest
    neighbour, then rewrites the edges between what is left.
    """
    edges = stash(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    roots = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        least = stash(both.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("node"), F.least("a", "b").alias("up")), "least")
        upper = least.select(F.col("node").alias("up"), F.col("up").alias("top"))
        step = stash(least.join(upper, "up").select("node", F.col("top").alias("up")), "step")
        if roots is None:
            roots = step.select("node", F.col("up").alias("root"))
        else:
            moved = step.select(F.col("node").alias("root"), "up")
            roots = roots.join(moved, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
        roots = stash(roots, "roots")
        a = step.select(F.col("node").alias("a"), F.col("up").alias("x"))
        b = step.select(F.col("node").alias("b"), F.col("up").alias("y"))
        edges = stash(edges.join(a, "a").join(b, "b").filter("x <> y").select(
            F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    return roots if roots is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(documents: DataFrame, percent: int = LINK_PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Two documents are linked if ``100 * |A & B| >= percent * |A | B|``. A text
    of fewer words than a shingle is one shingle. Null or wordless texts have no
    set and link with nothing. A row without id links with nothing, has a null
    component and is kept. Rows that repeat an id count as one document with
    the links of each. Other columns are ignored; an empty table gives no rows.
    """
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signs = stash(texts.mapInPandas(
        signed, "doc_id long, n_shingles long, set_hash binary, sig array<long>, bands array<long>"), "signatures")
    known = signs.filter("set_hash IS NOT NULL AND doc_id IS NOT NULL")
    classes = stash(known.groupBy("set_hash").agg(F.min("doc_id").alias("first")).withColumn(
        "cid", F.monotonically_increasing_id()), "classes")
    firsts = stash(known.join(classes, "set_hash").filter("doc_id = first").select(
        "cid", "first", "n_shingles", "sig", "bands"), "firsts")
    reps = stash(firsts.dropDuplicates(["cid"]), "reps")
    twice = firsts.count() > reps.count()  # rows that repeat id and text
    # Classes that an id has in common, as rows repeat it with other texts.
    several = stash(known.groupBy("doc_id").agg(F.min("set_hash").alias("a"), F.max("set_hash").alias("b")).filter(
        "a < b").select("doc_id"), "several")
    same = stash(known.select("doc_id", "set_hash").join(small_or_not(several), "doc_id").join(
        classes, "set_hash").select("doc_id", "cid").distinct(), "same-id")
    same_id = same.join(same.groupBy("doc_id").agg(F.min("cid").alias("a")), "doc_id").select("a", F.col("cid").alias("b"))
    # The smallest id is the likeliest original of a group of copies, so most of them are linked with it at once.
    banded = reps.select("cid", "first", F.explode("bands").alias("band"))
    pivots = banded.groupBy("band").agg(F.min(F.struct("first", "cid")).alias("pivot"), F.count("*").alias("n")).filter(
        "n > 1").select("band", F.col("pivot.cid").alias("p"))
    stars = stash(banded.join(pivots, "band").filter("p <> cid").select("p", F.col("cid").alias("x")).distinct(), "stars")

    def full_sets(wanted: DataFrame) -> DataFrame:
        named = classes.join(small_or_not(stash(wanted.distinct(), "wanted")), "cid").select(
            F.col("first").alias("doc_id"), "cid", "set_hash")
        found = texts.join(small_or_not(stash(named, "named")), "doc_id").select("text", "cid", "set_hash").mapInPandas(
            gathered, "cid long, items array<long>")
        return stash(found.dropDuplicates(["cid"]) if twice else found, "sets")

    def needed(size: Column) -> Column:
        """Common elements that a link needs, of two sets with ``size`` elements together."""
        return F.ceil(size * percent / (100 + percent))

    sets = full_sets(stars.select(F.col("p").alias("cid")).union(stars.select("x")))
    of_p = sets.select(F.col("cid").alias("p"), F.col("items").alias("items_p"))
    of_x = sets.select(F.col("cid").alias("x"), F.col("items").alias("items_x"))
    compared = stash(stars.join(of_p, "p").join(of_x, "x").select(
        "p", "x", F.size("items_x").alias("nx"), F.size("items_p").alias("np"),
        F.array_except("items_x", "items_p").alias("outside")).withColumn(
        "both", F.col("nx") - F.size("outside")).withColumn(
        "linked", F.col("both") >= needed(F.col("nx") + F.col("np"))), "compared")
    first = compared.filter("linked").select(F.col("p").alias("a"), F.col("x").alias("b"))
    roots = components(first)

    links = first.union(_links_beside_pivots(compared, reps, roots, sets, percent, needed))
    roots = components(links.union(same_id))

    least = roots.join(classes.select(F.col("cid").alias("node"), "first"), "node")
    component = least.groupBy("root").agg(F.min("first").alias("component"))
    named = stash(roots.join(component, "root").select(F.col("node").alias("cid"), "component"), "components")
    out = signs.join(classes, "set_hash", "left").join(named, "cid", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "first", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def one_of_each(documents: DataFrame, percent: int = LINK_PERCENT) -> DataFrame:
    """The rows of documents that ``near_duplicates`` keeps, all columns as they are."""
    gone = near_duplicates(documents, percent).filter(~F.col("kept")).select("doc_id").distinct()
    return documents.join(small_or_not(stash(gone, "gone")), "doc_id", "left_anti").select(*documents.columns)


def _links_beside_pivots(compared: DataFrame, reps: DataFrame, roots: DataFrame, sets: DataFrame, percent: int,
                         needed) -> DataFrame:
    """Links (a, b) between classes of one bucket that no pivot has brought together."""
    root = roots.withColumnRenamed("node", "x")
    open_groups = compared.filter("NOT linked").select("p").distinct()
    sizes = compared.groupBy("p").agg(F.min("nx").alias("least"))
    rows = stash(compared.join(open_groups, "p", "left_semi").join(sizes, "p").join(root, "x", "left").withColumn(
        "root", F.coalesce("root", "x")), "open")
    # A partner has at least the share ``percent`` of x's elements, and no fewer than the group's smallest.
    fewest = F.greatest(F.ceil(F.col("nx") * percent / 100), F.col("least"))
    rows = rows.withColumn("wanted", F.greatest(needed(F.col("nx") + fewest) - F.col("both"), F.lit(1)))

    each = rows.select("p", "x", "linked", "root", "wanted", F.explode("outside").alias("item"))
    shared = each.groupBy("p", "item").agg(F.count("*").alias("often")).filter("often > 1")
    each = stash(each.join(shared, ["p", "item"]), "outside")
    counts = each.groupBy("p", "x").agg(F.count("*").alias("held"))
    # Elements nobody else has come first in the order and cannot meet; of the others this many are enough.
    rarest = Window.partitionBy("p", "x").orderBy("often", "item")
    prefix = stash(each.join(counts, ["p", "x"]).filter("held >= wanted").withColumn("at", F.row_number().over(rarest))
                   .filter("at <= held - wanted + 1").select("p", "item", "x", "linked", "root"), "prefix")
    x = prefix.filter("NOT linked").drop("linked")
    y = prefix.select("p", "item", F.col("x").alias("y"), F.col("root").alias("root_y"))
    met = x.join(y, ["p", "item"]).filter("root <> root_y").select("x", "y").distinct()

    most = F.floor(F.col("both") * (100 + percent) / percent - F.col("nx"))
    low = rows.filter("NOT linked").withColumn("most", most).filter(F.col("most") >= fewest).select(
        "p", "x", "most", "root")
    bound = low.groupBy("p").agg(F.max("most").alias("bound"))
    small = rows.join(bound, "p").filter("nx <= bound").select(
        "p", F.col("x").alias("y"), F.col("nx").alias("ny"), F.col("root").alias("root_y"))
    contained = low.join(small, "p").filter("ny <= most AND root <> root_y").select("x", "y")

    sig_x = reps.select(F.col("cid").alias("x"), F.col("sig").alias("sig_x"))
    sig_y = reps.select(F.col("cid").alias("y"), F.col("sig").alias("sig_y"))
    pairs = met.union(contained).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    likely = stash(pairs.join(sig_x, "x").join(sig_y, "y").filter(
        estimate(F.col("sig_x"), F.col("sig_y")) >= LEAST_ESTIMATE).select("x", "y"), "pairs")
    of_x = sets.select(F.col("cid").alias("x"), F.col("items").alias("items_x"))
    of_y = sets.select(F.col("cid").alias("y"), F.col("items").alias("items_y"))
    return stash(likely.join(of_x, "x").join(of_y, "y").filter(
        F.size(F.array_intersect("items_x", "items_y")) >= needed(F.size("items_x") + F.size("items_y"))).select(
        F.col("x").alias("a"), F.col("y").alias("b")), "links")
