"""Exact centroid clustering of integer vectors, with distances ruled out by Ptolemy's inequality over pivot pairs."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiframe.session import materialize

LIMIT = 1 << 27  # of a component: squared distances of 64 components then fit a long
SLACK = 1e-13  # far above what a few roundings of doubles can add up to
BLOCK_ROWS = 4096


@dataclass
class Pivots:
    """Fixed points, and the pairs of them that give bounds."""

    points: np.ndarray

    def __post_init__(self):
        n = len(self.points)
        ring = [(i, (i + 1) % n) for i in range(n)] if n > 2 else [(0, 1)][: n - 1]
        gaps = [(i, j, float(np.sqrt(squared(self.points[i : i + 1], self.points[j])[0]))) for i, j in ring]
        self.pairs = [(i, j, gap) for i, j, gap in gaps if gap > 0]

    def distances(self, rows: np.ndarray) -> np.ndarray:
        """Distance of every row to every pivot."""
        return np.sqrt(np.stack([squared(rows, p) for p in self.points], axis=1).astype(np.float64))

    def bounds(self, near: np.ndarray, centres: np.ndarray) -> np.ndarray:
        """Lower bounds of the squared distances between rows and centres, both known by their distances to the pivots.

        Ptolemy's inequality, ``d(x,c) d(p,q) >= |d(x,p) d(c,q) - d(x,q) d(c,p)|``, for every pair; the rounding of each
        step is taken off, so a bound is never above the true value.
        """
        low = np.zeros((len(near), len(centres)))
        for i, j, gap in self.pairs:
            one, two = np.outer(near[:, i], centres[:, j]), np.outer(near[:, j], centres[:, i])
            np.maximum(low, (np.abs(one - two) - SLACK * (one + two)) / gap, out=low)
        return low * low * (1 - SLACK)


def squared(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to a point."""
    gap = rows - point
    return np.einsum("ij,ij->i", gap, gap)


def nearest(rows: np.ndarray, near: np.ndarray, centres: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centre of each row (of equals the first), its squared distance, and how many distances were computed.

    The centre of the smallest bound is measured; another only where its bound does not exceed the best so far.
    """
    low = pivots.bounds(near, pivots.distances(centres))
    which = low.argmin(axis=1)
    first, best, measured = which.copy(), np.zeros(len(rows), np.int64), len(rows)
    for c in range(len(centres)):
        own = np.flatnonzero(first == c)
        best[own] = squared(rows[own], centres[c])
    for c in range(len(centres)):
        open_ = np.flatnonzero((first != c) & (low[:, c] <= best))
        found = squared(rows[open_], centres[c])
        measured += len(open_)
        better = (found < best[open_]) | ((found == best[open_]) & (c < which[open_]))
        which[open_[better]], best[open_[better]] = c, found[better]
    return which, best, measured


def integer_vectors(vectors: DataFrame, key: str, column: str, dims: int, scale: int) -> DataFrame:
    """``(key, v)``: ``floor(scale * x)`` of every component, for vectors of ``dims`` components that are all finite numbers."""
    scaled = F.transform(F.col(column), lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    usable = (F.size(column) == dims) & F.forall(
        F.col(column), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float(LIMIT) / scale))
    )
    return vectors.select(key, F.when(usable, scaled.cast("array<int>")).alias("v")).where("v IS NOT NULL")


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def ptolemaic_clusters(
    vectors: DataFrame,
    key: str = "vec_id",
    column: str = "embedding",
    k: int = 8,
    rounds: int = 10,
    dims: int = 64,
    scale: int = 1024,
    seed: int = 3,
) -> tuple[DataFrame, DataFrame]:
    """``(key, cluster, distance)`` per vector and ``(cluster, centroid, n)`` per cluster, exact in integers.

    Kept are vectors of ``dims`` components, none null, non-finite or beyond ``LIMIT`` when scaled (its square would not
    fit a long). Components become ``floor(scale * x)``. Centroids start as the ``k`` vectors of smallest SHA-256 of
    ``seed:key``; with fewer vectors there are fewer, a null key is never chosen, and rows of one key go by their
    components. Each round assigns every vector to the nearest centroid (of equals the smaller number) and moves every
    centroid to the floored mean of its vectors; one without vectors stays. Then all are assigned once more. Repeated rows
    count each. No vectors give two empty results.

    The first centroids are the pivots: every vector's distances to them are stored beside it once, and in each round
    bounds from them spare most exact distances. The vectors stay where they lie; a round sends sums per task and cluster,
    added up by Spark, and only ``k`` of them reach the driver.
    """
    spark = vectors.sparkSession
    whole = integer_vectors(vectors, key, column, dims, scale)
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"), 256)
    chosen = whole.select(name.alias("h"), "v").where("h IS NOT NULL").orderBy("h", "v").limit(k).collect()
    kind = T.StructField(key, vectors.schema[key].dataType)
    long = T.LongType()
    rows_schema = T.StructType([kind, T.StructField("cluster", T.IntegerType()), T.StructField("distance", long)])
    centroid_schema = "cluster int, centroid array<long>, n long"
    if not chosen:
        return spark.createDataFrame([], rows_schema), spark.createDataFrame([], centroid_schema)
    centres = np.array([r["v"] for r in chosen], np.int64)
    pivots = Pivots(centres)  # k points of dims numbers: they travel with the task
    near_schema = T.StructType([kind, T.StructField("v", T.ArrayType(T.IntegerType())), T.StructField("near", T.ArrayType(T.DoubleType()))])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = pivots.distances(_matrix(batch.column(1), dims).astype(np.int64))
            offsets = np.arange(0, near.size + 1, len(pivots.points), dtype=np.int32)
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(near.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=near_schema.names)

    table = materialize(whole.mapInArrow(measured, near_schema), "near")

    def blocks(batches: Iterator[pa.RecordBatch], centres: np.ndarray):
        """Some rows of the table, their matrix, nearest centres and squared distances."""
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                rows = _matrix(part.column(1), dims).astype(np.int64)
                near = _matrix(part.column(2), len(pivots.points))
                which, best, _ = nearest(rows, near, centres, pivots)
                yield part, rows, which, best

    def summed(centres: np.ndarray) -> list:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, totals = np.zeros(len(centres), np.int64), np.zeros(centres.shape, np.int64)
            for _, rows, which, _ in blocks(batches, centres):
                n += np.bincount(which, minlength=len(centres))
                for c in np.unique(which):
                    totals[c] += rows[which == c].sum(axis=0)
            full = np.flatnonzero(n)
            columns = [pa.array(full.astype(np.int32)), pa.array(n[full]), pa.array(totals[full].tolist(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["cluster", "n", "totals"])

        parts = table.mapInArrow(run, "cluster int, n long, totals array<long>")
        exact = [F.sum(F.col("totals")[j].cast("decimal(20, 0)")).alias(f"t{j}") for j in range(dims)]
        return parts.groupBy("cluster").agg(F.sum("n").alias("n"), *exact).collect()  # k rows at most

    for _ in range(rounds):
        moved = centres.copy()
        for r in summed(centres):
            moved[r["cluster"]] = [int(r[f"t{j}"]) // r["n"] for j in range(dims)]
        centres = moved
    last = centres

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, which, best in blocks(batches, last):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(which.astype(np.int32)), pa.array(best)], names=rows_schema.names)

    rows = materialize(table.mapInArrow(assigned, rows_schema), "assigned")
    points = spark.createDataFrame([(c, [int(x) for x in v]) for c, v in enumerate(last)], "cluster int, centroid array<long>")
    sizes = rows.groupBy("cluster").agg(F.count("*").alias("n"))
    found = points.join(F.broadcast(sizes), "cluster", "left")  # one row per cluster
    return rows, found.select("cluster", "centroid", F.coalesce("n", F.lit(0)).alias("n"))
