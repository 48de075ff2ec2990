"""K-means over whole numbers with a table of pivot distances (LAESA).

Vectors become whole numbers, so that every distance, sum and mean is exact and does
not depend on how the rows are cut. The distances of each vector to a few fixed
pivots are computed once and stored with it. In each round the pivots' distances to
the centroids are known as well, and by the triangle inequality the largest
difference of the two, over the pivots, is a lower bound of the distance between
vector and centroid. The centroid of the least bound is tried first; the others get an
exact distance only where their bound does not exceed it.

A round is one pass over the stored table. Tasks add up their vectors by cluster;
the driver sees clusters x components sums, whatever the number of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stash

CLUSTERS, ROUNDS, COMPONENTS, PIVOTS = 8, 10, 64, 16
SCALE = 1024
#: Larger whole numbers are held at this, so that squared distances fit in a long: 64 * (2**28)**2 = 2**62.
MOST = 1 << 27
LONG = (1 << 63) - 1
#: Bounds are kept by so much, relative to the distances, against the rounding of roots.
SLACK = 1e-9
#: Vectors that a task measures at once.
BLOCK = 4096

Assigned = tuple[np.ndarray, np.ndarray]


def as_integers(column: str, size: int) -> Column:
    """The vector as whole numbers; null unless it has ``size`` components, none null or non-finite."""
    x = F.col(column)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.floor(F.greatest(F.lit(-float(MOST)), F.least(
        F.lit(float(MOST)), v.cast("double") * SCALE))).cast("int"))
    return F.when((F.size(x) == size) & F.coalesce(finite, F.lit(False)), whole)


def squared(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of whole numbers to one point."""
    gap = x - centre
    return np.einsum("ij,ij->i", gap, gap)


def nearest(x: np.ndarray, to_pivots: np.ndarray, centres: np.ndarray, pivots: np.ndarray) -> Assigned:
    """For each row the nearest centre, of equally near ones the first, and the exact squared distance."""
    between = np.sqrt(np.array([squared(pivots, c) for c in centres], "float64"))
    bound = np.zeros((len(x), len(centres)))
    for j in range(len(pivots)):
        np.maximum(bound, np.abs(to_pivots[:, j, None] - between[None, :, j]), out=bound)
    first = bound.argmin(axis=1)
    best, at = np.empty(len(x), "int64"), first.copy()
    for k in range(len(centres)):
        mine = first == k
        best[mine] = squared(x[mine], centres[k])
    # Distances are rounded by parts in 10**16; the slack, of the distances that went into the bound, is far above that.
    slack = SLACK * (1 + to_pivots.max(axis=1, initial=0) + between.max(initial=0))
    for k in range(len(centres)):
        open_ = np.flatnonzero((first != k) & (bound[:, k] <= np.sqrt(best.astype("float64")) + slack))
        exact = squared(x[open_], centres[k])
        closer = (exact < best[open_]) | (exact == best[open_]) & (k < at[open_])
        best[open_[closer]], at[open_[closer]] = exact[closer], k
    return at, best


def matrix(column: pd.Series, kind: str, width: int) -> np.ndarray:
    return np.concatenate(column.to_list()).astype(kind).reshape(len(column), width) if len(column) else np.empty((0, width), kind)


def with_pivots(pivots: np.ndarray) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = matrix(pdf["ints"], "int64", pivots.shape[1])
            table = np.sqrt(np.array([squared(x, p) for p in pivots], "float64").reshape(len(pivots), len(x)).T)
            yield pdf.assign(to_pivots=list(table))
    return run


def assigning(centres: np.ndarray, pivots: np.ndarray, result: Callable) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def parts() -> Iterator[tuple]:
            for pdf in batches:
                for a in range(0, len(pdf), BLOCK):
                    piece = pdf.iloc[a: a + BLOCK]
                    x = matrix(piece["ints"], "int64", pivots.shape[1])
                    yield piece, x, *nearest(x, matrix(piece["to_pivots"], "float64", len(pivots)), centres, pivots)
        yield from result(parts())
    return run


def summed(clusters: int, width: int) -> Callable:
    """Sums by cluster of a task's vectors, sent on well before a long could overflow."""
    def result(parts: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        sums, count = np.zeros((clusters, width), "int64"), np.zeros(clusters, "int64")

        def out() -> pd.DataFrame:
            some = np.flatnonzero(count)
            return pd.DataFrame({"cluster": np.repeat(some, width), "place": np.tile(np.arange(width), len(some)),
                                 "total": sums[some].ravel(), "n": np.repeat(count[some], width)})

        for _, x, at, _ in parts:
            for k in np.unique(at):
                sums[k] += x[at == k].sum(axis=0)
            count += np.bincount(at, minlength=clusters)
            if count.sum() > 1 << 34:
                yield out()
                sums[:], count[:] = 0, 0
        yield out()
    return result


def placed(parts: Iterator[tuple]) -> Iterator[pd.DataFrame]:
    for piece, _, at, best in parts:
        yield piece[["vec_id", "unnamed"]].assign(cluster=at.astype("int32"), distance=best)


def cluster_vectors(vectors: DataFrame, column: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS,
                    size: int = COMPONENTS, n_pivots: int = PIVOTS) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Kept are vectors of ``size`` components, none null or non-finite. The first
    centroids are the vectors with the smallest hashes of their ids; the
    pivots are these and the ones that follow. Repeated rows are rows of
    their own; rows that share an id start in the order of their components.
    A null id never starts but is assigned; with fewer starts than
    ``clusters`` there are fewer clusters, and with none no rows. Components
    whose whole number is beyond MOST count as MOST, and an inertia beyond a
    long is the largest long. Other columns are ignored.
    """
    spark = vectors.sparkSession
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), as_integers(column, size).alias("ints")).filter(
        "ints IS NOT NULL")
    order = F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")), 256)
    starts = kept.filter("vec_id IS NOT NULL").withColumn("order", order).orderBy("order", "ints").limit(
        max(clusters, n_pivots)).collect()
    if not starts:
        return kept.limit(0).select("vec_id", F.lit(0).alias("cluster"), *[
            F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")], F.lit("").alias(
            "centroid_sha256"))
    points = np.array([r["ints"] for r in starts], "int64")
    centres, pivots = points[:clusters], points[:n_pivots]
    # Nulls would turn the ids of their batch into floats.
    named = kept.select(F.coalesce("vec_id", F.lit(0)).alias("vec_id"), F.col("vec_id").isNull().alias("unnamed"), "ints")
    table = stash(named.mapInPandas(
        with_pivots(pivots), "vec_id long, unnamed boolean, ints array<int>, to_pivots array<double>"), "pivots")

    for _ in range(rounds):
        sums = table.mapInPandas(assigning(centres, pivots, summed(len(centres), size)),
                                 "cluster int, place int, total long, n long")
        wide = [F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("total", "n")]
        centres = centres.copy()
        for r in sums.groupBy("cluster", "place").agg(*wide).collect():
            centres[r["cluster"], r["place"]] = int(r["total"]) // int(r["n"])

    done = stash(table.mapInPandas(assigning(centres, pivots, placed),
                                   "vec_id long, unnamed boolean, cluster int, distance long"), "placed")
    totals = {r["cluster"]: int(r["d"]) for r in done.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(20,0)")).alias("d")).collect()}
    about = spark.createDataFrame([
        (k, min(totals.get(k, 0), LONG), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest())
        for k, c in enumerate(centres)], "cluster int, cluster_inertia long, centroid_sha256 string")
    return done.join(F.broadcast(about), "cluster").select(
        F.when(~F.col("unnamed"), F.col("vec_id")).alias("vec_id"), "cluster", "distance", "cluster_inertia",
        F.lit(min(sum(totals.values()), LONG)).cast("long").alias("inertia"), "centroid_sha256")
