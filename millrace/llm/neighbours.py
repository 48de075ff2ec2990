"""Nearest neighbours by cross-polytope hashing.

A unit vector is rotated by fast Hadamard transforms with random signs and falls to
the signed axis it is nearest to, one of 2 x dimensions. Where these cells would hold more
than CELL_ROWS vectors on average, further rotations split them, the last one cut to a
power of two of dimensions. TABLES such tables are laid over the vectors.

A query probes more than its own cell: all whose axes it is near enough to. How near is
near enough follows from how far its neighbours are. The less two vectors have in
common, the lower the query's projection on the axes its neighbour fell to; a
simulation with the same rotations gives, for each cosine, the projection that all
but MISSED of the pairs reach in their best table. So first each query looks into
its best cells of one table; the last of the best it finds is a lower bound of its
neighbours' cosines. Then it probes all cells of all tables beyond the projection
for that bound. Its neighbours are found with the same chance whether they are
near or far: far ones cost more cells, up to all of one table, which is a search
of everything. Products of the original vectors decide, in double precision.

For products of vectors that are not of one length the longest gets length one, and
the others a further component that fills theirs up; the product is then the cosine
times both greatest lengths.

Cells are dealt to parts by hash. Rows of a cell beyond UNIT_ROWS are cut into blocks,
and so are the queries that visit it; each pair of blocks meets in some part. A
part's vectors are held in a task, queries stream past them. Equal vectors are one,
with the smallest of their ids, which are all that a result can hold.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from millrace.llm.common import small_or_not, stash

NEAREST, EVERY = 20, 20
TABLES, LEAST_ROWS, CELL_ROWS, MISSED = 4, 16, 4096, 0.06
#: Rows of a cell, or queries that visit it, in one block; vectors, and queries' visits, for which one more part is made.
UNIT_ROWS, PART_ROWS, PART_VISITS = 4096, 16_384, 262_144
#: Vectors that a query's first look is to meet, about.
FIRST_ROWS = 4096
#: Queries that are compared at once with the vectors of a part.
BLOCK = 256
#: Pairs in the simulation, for each step of the cosine.
SIMULATED, STEP = 2000, 0.025
#: A query's own vector may be among its best.
BEST = NEAREST + 1


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of rows, scaled to keep lengths."""
    n, size = x.shape
    h = 1
    while h < size:
        pair = x.reshape(n, size // (2 * h), 2, h)
        x = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(n, size)
        h *= 2
    return x / np.sqrt(size)


@dataclass
class Hashes:
    """Rotations of TABLES tables; ``cuts`` are the dimensions of each table's polytopes."""

    size: int
    cuts: tuple[int, ...]

    def __post_init__(self):
        rng = np.random.default_rng(12)
        self.signs = rng.choice([-1.0, 1.0], (TABLES, len(self.cuts), 3, self.size))
        self.cells = int(np.prod([2 * c for c in self.cuts]))

    def projections(self, x: np.ndarray, table: int) -> list[np.ndarray]:
        """By polytope, the projections on its axes and their opposites."""
        out = []
        for signs, cut in zip(self.signs[table], self.cuts):
            y = x
            for s in signs:
                y = hadamard(y * s)
            out.append(np.concatenate([y[:, :cut], -y[:, :cut]], axis=1))
        return out

    def cell(self, x: np.ndarray) -> np.ndarray:
        """Cells of the rows, numbered over all tables."""
        out = np.empty((len(x), TABLES), "int64")
        for t in range(TABLES):
            at = np.full(len(x), t, "int64")
            for p in self.projections(x, t):
                at = at * p.shape[1] + p.argmax(axis=1)
            out[:, t] = at
        return out

    def thresholds(self) -> np.ndarray:
        """By cosine in steps from 0, the sum of projections that a pair's best table reaches but for MISSED."""
        rng = np.random.default_rng(13)
        x, other = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in rng.normal(size=(2, SIMULATED, self.size)))
        other -= (x * other).sum(axis=1, keepdims=True) * x
        other /= np.maximum(np.linalg.norm(other, axis=1, keepdims=True), 1e-12)
        cosines = np.arange(0, 1 + STEP, STEP)[:, None]
        best = np.full((len(cosines), SIMULATED), -np.inf)
        for t in range(TABLES):
            total = np.zeros_like(best)
            for px, po in zip(self.projections(x, t), self.projections(other, t)):
                # The query is cos * x + sin * other, so its projections on the axis of x are sums of theirs.
                at = px.argmax(axis=1)[:, None]
                a, b = (np.take_along_axis(p, at, 1)[:, 0] for p in (px, po))
                total += cosines * a + np.sqrt(np.maximum(1 - cosines**2, 0)) * b
            best = np.maximum(best, total)
        return np.quantile(best, MISSED, axis=1)


def cuts_for(size: int, rows: int) -> tuple[int, ...]:
    """Dimensions of the polytopes: a whole one, or less for few rows, then what brings cells to CELL_ROWS on average."""
    def part(cells: int) -> int:
        return min(size, 1 << max((cells // 2).bit_length() - 1, 0))

    cuts = [part(max(rows // LEAST_ROWS, 2))]
    rows //= 2 * cuts[0]
    while rows >= 4 * CELL_ROWS and size > 1:
        cuts.append(part(rows // CELL_ROWS))
        rows //= 2 * cuts[-1]
    return tuple(cuts)


def matrix(column: pd.Series, width: int) -> np.ndarray:
    """Rows of numbers; shorter ones end in zeros."""
    out = np.zeros((len(column), width))
    for row, v in zip(out, column):
        row[: len(v)] = v
    return out


def unit(x: np.ndarray, longest: float, size: int, queries: bool) -> np.ndarray:
    """Vectors of length one in ``size`` dimensions, whose products with queries are in the order of the originals'."""
    out = np.zeros((len(x), size))
    norms = np.linalg.norm(x, axis=1, keepdims=True)
    out[:, : x.shape[1]] = x / (norms if queries or size == x.shape[1] else longest)
    if not queries and size > x.shape[1]:
        out[:, x.shape[1]] = np.sqrt(np.maximum(1 - (norms[:, 0] / longest) ** 2, 0))
    return out


def hashing(hashes: Hashes, width: int, longest: float) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            cells = hashes.cell(unit(matrix(pdf["vec"], width), longest, hashes.size, False))
            yield pdf.assign(cells=list(cells))
    return run


def beyond(projections: list[np.ndarray], limit: float, table: int) -> np.ndarray:
    """Cells of one query in one table whose projections add up to ``limit``."""
    at, total = np.array([table], "int64"), np.zeros(1)
    rest = np.append(np.cumsum([p.max() for p in projections][::-1])[::-1][1:], 0)
    for p, more in zip(projections, rest):
        sums = total[:, None] + p[None, :]
        which, axis = np.nonzero(sums + more >= limit)
        at, total = at[which] * len(p) + axis, sums[which, axis]
    return at


def highest(projections: list[np.ndarray], most: int, table: int) -> np.ndarray:
    """The ``most`` cells of one query in one table with the highest sums of projections."""
    at, total = np.array([table], "int64"), np.zeros(1)
    for p in projections:
        sums = (total[:, None] + p[None, :]).ravel()
        # No cell of the best can begin with what is not among the best so far.
        best = np.argsort(-sums, kind="stable")[:most]
        at, total = at[best // len(p)] * len(p) + best % len(p), sums[best]
    return at


def probing(hashes: Hashes, limits: np.ndarray | int, width: int, longest: float) -> Callable:
    """Cells that each query visits: so many of the best in one table, or those beyond the limit for its cosine so far."""
    def visits(p: list[list[np.ndarray]], cosine: float) -> np.ndarray:
        if isinstance(limits, int):
            return highest(p[0], limits, 0)
        if not cosine > 0:  # no bound yet: all cells of one table are all vectors
            return np.arange(hashes.cells)
        limit = limits[min(int(cosine / STEP), len(limits) - 1)]
        found = [beyond(p[t], limit, t) for t in range(TABLES)]
        # If so many that one table costs no more, look at everything.
        return np.concatenate(found) if sum(map(len, found)) < hashes.cells else np.arange(hashes.cells)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a in range(0, len(pdf), BLOCK):
                piece = pdf.iloc[a: a + BLOCK]
                x = matrix(piece["vec"], width)
                u = unit(x, longest, hashes.size, True)
                lengths = np.linalg.norm(x, axis=1) * longest
                by_table = [hashes.projections(u, t) for t in range(TABLES)]
                cosines = piece["least"].to_numpy("float64") / lengths - 1e-9
                yield pd.DataFrame({"q": piece["v"].to_numpy(), "cells": [
                    visits([[p[i] for p in table] for table in by_table], cosine) for i, cosine in enumerate(cosines)]})
    return run


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Products of rows, added up from the first component to the last, so that they don't depend on what is about."""
    return np.cumsum(x * q, axis=1)[:, -1]


def meeting(width: int) -> Callable:
    """Rows sorted by part, its vectors before the queries: the best of the units that each query visits, at least ``least``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held, ready = None, [], None
        for pdf in batches:
            asks = pdf["is_query"].to_numpy()
            for number in pd.unique(pdf["part"]):
                here = pdf["part"].to_numpy() == number
                if number != part:
                    part, held, ready = number, [], None
                if (here & ~asks).any():
                    held.append(pdf.loc[here & ~asks, ["v", "unit", "vec"]])
                questions = pdf[here & asks]
                if not len(questions) or not held:
                    continue
                if ready is None:
                    points = pd.concat(held).sort_values("unit", kind="stable")
                    # A vector may be here by several tables.
                    ids, at, place = np.unique(points["v"].to_numpy(), return_index=True, return_inverse=True)
                    ready = ids, place, points["unit"].to_numpy(), matrix(points["vec"].iloc[at], width)
                for a in range(0, len(questions), BLOCK):
                    yield best_of(questions.iloc[a: a + BLOCK], *ready)

    def best_of(questions: pd.DataFrame, ids: np.ndarray, place: np.ndarray, units: np.ndarray,
                x: np.ndarray) -> pd.DataFrame:
        q = matrix(questions["vec"], width)
        scores = np.full((len(q), len(x)), -np.inf)
        asked = np.concatenate(questions["units"].to_list())
        row = np.repeat(np.arange(len(q)), questions["units"].map(len))
        by = np.argsort(asked, kind="stable")
        asked, row = asked[by], row[by]
        here = np.unique(asked)
        for u, a, b, lo, hi in zip(here, np.searchsorted(asked, here), np.searchsorted(asked, here, side="right"),
                                   np.searchsorted(units, here), np.searchsorted(units, here, side="right")):
            if lo < hi:
                scores[np.ix_(row[a:b], place[lo:hi])] = q[row[a:b]] @ x[place[lo:hi]].T
        least = np.nan_to_num(questions["least"].to_numpy("float64"), nan=-np.inf)
        if len(x) > BEST:
            cut = -np.partition(-scores, BEST - 1, axis=1)[:, BEST - 1]
            least = np.maximum(least, cut)
        # Whole products are rounded in another order than these; the margin is far above that.
        size = np.linalg.norm(q, axis=1) * (np.linalg.norm(x, axis=1).max(initial=0))
        who, which = np.nonzero((scores >= (least - 1e-9 * size)[:, None]) & (scores > -np.inf))
        return pd.DataFrame({"q": questions["v"].to_numpy()[who], "v": ids[which], "score": products(x[which], q[who])})

    return run


def best_per_query(found: DataFrame, most: int) -> DataFrame:
    """The best of each query, each vector once, ties to the smaller id."""
    order = Window.partitionBy("q").orderBy(F.desc("score"), "v")
    return found.groupBy("q", "v").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= most)


def usable(column: str, kind: str) -> Column:
    """The vector, if it takes part; -0.0 is 0.0."""
    x = F.col(column)
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    return F.when(F.coalesce(good, F.lit(False)), F.transform(x, lambda v: v.cast(kind) + F.lit(0.0).cast(kind)))


def nearest_neighbours(vectors: DataFrame, column: str = "embedding", every: int = EVERY) -> DataFrame:
    """The NEAREST of each query by largest product: query_id, rank, vec_id, score.

    Queries are the ids divisible by ``every``. Vectors that are null, zero or
    hold null or non-finite components take no part, nor do rows without
    id. Of rows that repeat an id the one with the least vector counts. A shorter
    vector is one that ends in zeros. With fewer candidates all are returned;
    a query alone has no rows, and an empty table gives none. Other columns are
    ignored. Products must not overflow a double.
    """
    kind = "float" if vectors.schema[column].dataType == ArrayType(FloatType()) else "double"
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), usable(column, kind).alias("vec")).filter(
        "id IS NOT NULL AND vec IS NOT NULL").groupBy("id").agg(F.min("vec").alias("vec"))
    among = Window.partitionBy("vec").orderBy("id")
    copies = rows.withColumn("nth", F.row_number().over(among)).filter(F.col("nth") <= BEST)
    classes = stash(copies.groupBy("vec").agg(F.min("id").alias("v"), F.sort_array(F.collect_list("id")).alias("ids")),
                    "classes")
    # Every query of a class has the class's neighbours, whichever of its copies it is.
    asking = stash(rows.filter(F.col("id") % every == 0).join(
        classes.select("vec", "v"), "vec").select(F.col("id").alias("query_id"), "v"), "asking")
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    about = classes.select(norm.alias("norm"), F.size("vec").alias("width")).agg(
        F.count("*").alias("n"), F.max("norm").alias("longest"), F.min("norm").alias("shortest"),
        F.max("width").alias("width")).first()
    n, width, longest = about["n"], about["width"] or 1, about["longest"] or 1.0
    uneven = (about["shortest"] or 1.0) < longest * (1 - 1e-5)
    size = 1 << (width + uneven - 1).bit_length()
    hashes = Hashes(size, cuts_for(size, n))
    limits = hashes.thresholds()

    index = stash(classes.select("v", "vec").mapInPandas(
        hashing(hashes, width, longest), f"v long, vec array<{kind}>, cells array<long>"), "index")
    queries = classes.join(small_or_not(asking.select("v").distinct()), "v", "left_semi").select("v", "vec")
    unknown = F.lit(None).cast("double").alias("least")

    def look(asked: DataFrame, tables: int, limit: np.ndarray | int, label: str) -> DataFrame:
        """What queries (v, vec, least) find in the cells they visit: (q, v, score)."""
        visits = stash(asked.mapInPandas(probing(hashes, limit, width, longest), "q long, cells array<long>"), f"{label}-visits")
        visits = visits.select("q", F.explode("cells").alias("cell"))
        entries = index.select("v", F.explode(F.slice("cells", 1, tables)).alias("cell"))
        held = entries.groupBy("cell").agg(F.count("*").alias("rows"))
        met = stash(held.join(visits.groupBy("cell").agg(F.count("*").alias("visits")), "cell").select(
            "cell", F.ceil(F.col("rows") / UNIT_ROWS).cast("int").alias("row_blocks"),
            F.ceil(F.col("visits") / UNIT_ROWS).cast("int").alias("visit_blocks"), "rows", "visits"), f"{label}-cells")
        sums = met.agg(F.sum(F.col("rows") * F.col("visit_blocks")), F.sum(F.col("visits") * F.col("row_blocks"))).first()
        parts = max(1, -(-(sums[0] or 0) // PART_ROWS), -(-(sums[1] or 0) // PART_VISITS))
        met = small_or_not(met.select("cell", "row_blocks", "visit_blocks"))

        def block(key: str, blocks: str) -> Column:
            return F.pmod(F.xxhash64(key), F.col(blocks)).cast("int")

        def blocks(name: str) -> Column:
            return F.explode(F.sequence(F.lit(0), F.col(name) - 1))

        unit_of = F.xxhash64("cell", "row_block", "visit_block")
        part = F.pmod(unit_of, F.lit(parts)).cast("int").alias("part")
        points = entries.join(met, "cell").withColumn("row_block", block("v", "row_blocks")).withColumn(
            "visit_block", blocks("visit_blocks")).select("v", part, unit_of.alias("unit"))
        asks = visits.join(met, "cell").withColumn("visit_block", block("q", "visit_blocks")).withColumn(
            "row_block", blocks("row_blocks")).groupBy(F.col("q").alias("v"), part).agg(F.collect_list(unit_of).alias("units"))
        places = points.groupBy("v").agg(F.collect_list(F.struct("part", "unit")).alias("places"))
        sent = index.select("v", "vec").join(places, "v").select("v", "vec", F.inline("places")).select(
            "part", F.lit(False).alias("is_query"), "v", "vec", "unit", F.lit(None).cast("array<long>").alias("units"), unknown)
        questions = asks.join(asked, "v").select(
            "part", F.lit(True).alias("is_query"), "v", "vec", F.lit(0).cast("long").alias("unit"), "units", "least")
        return sent.union(questions).repartition("part").sortWithinPartitions("part", "is_query").mapInPandas(
            meeting(width), "q long, v long, score double")

    some = -(-FIRST_ROWS * hashes.cells // max(n, 1))
    first = stash(best_per_query(look(queries.select("v", "vec", unknown), 1, some, "first"), BEST), "first")
    bounds = first.filter(F.col("rank") == BEST).select(F.col("q").alias("v"), F.col("score").alias("least"))
    wider = stash(queries.join(bounds, "v", "left").select("v", "vec", "least"), "bounds")
    found = stash(look(wider, TABLES, limits, "wide"), "found")

    # The first look may have met some that the second had no reason to visit again.
    best = best_per_query(found.union(first.select("q", "v", "score")), BEST).select("q", "v", "score")
    named = asking.withColumnRenamed("v", "q").join(best, "q").join(classes.select("v", "ids"), "v").select(
        "query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return named.withColumn("rank", rank).filter(F.col("rank") <= NEAREST).select("query_id", "rank", "vec_id", "score")
