"""Centroid clustering in whole numbers with a LAESA pivot table.

Vectors with exactly ``DIMS`` finite components take part; a component x becomes floor(64 * x), x
as double. The first centroids are the ``CENTROIDS`` vectors whose ``1:<vec_id>`` has the least sha256,
in that order. Each of ``ROUNDS`` rounds assigns every vector to the nearest centroid (squared
Euclidean distance, ties to the smaller number) and moves each non-empty centroid to the exact
floor of its vectors' means; then vectors are assigned once more.

Pivot table. The first centroids are also the pivots. Every vector's distances to them are computed
and stored once. In a round each centroid's distances to the pivots are known, and for a vector x, a
centroid c and every pivot p, |d(x, p) - d(c, p)| <= d(x, c); the largest difference is a lower
bound. Centroids are visited in the order of their bounds. One whose bound lies above the best
exact distance so far is out; the others get exact integer distances. Bounds carry a margin for
rounding, so results are those of the full search.

Distribution. Vectors stay where they are: a round is one pass over the stored table in which a task
emits at most one row of exact sums for each centroid. Only the centroids, 16 by 64 numbers, meet
in the driver and go out with the next pass; nothing is shuffled by vector, so a vector that
repeats very often has no effect on the spread of the work.

Handling. A null or wrongly sized vector, or one with a null or non-finite component, is left out of
the result. A null vec_id takes part but is never a first centroid. Rows that repeat a vec_id are
vectors of their own; among first centroids equal hashes are ordered by their components. Fewer
vectors than centroids give as many centroids as there are such vectors; without any (an empty
table, or only null ids) the result is empty. Only vec_id and embedding are read, so further columns
may have any name. A component or a distance beyond the long range is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage

DIMS = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
SEED = 1
#: Components below this have squared distances that fit a long and sums that fit a double's order.
USUAL = 1 << 27
LONG = 1 << 63


def kept(vectors: DataFrame) -> DataFrame:
    """vec_id and whole components of the vectors that take part."""
    wide = lambda x: x.cast("double") * F.lit(float(SCALE))

    def whole(x: Column) -> Column:
        outside = F.raise_error(F.lit("a component leaves the long range once scaled")).cast("long")
        return F.when(F.abs(wide(x)) < F.lit(float(LONG)), F.floor(wide(x))).otherwise(outside)

    finite = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))), F.lit(False)))
    usable = F.col("embedding").isNotNull() & (F.size("embedding") == DIMS) & finite
    return vectors.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", whole).alias("v"))


def first_centroids(rows: DataFrame, count: int = CENTROIDS) -> list[list[int]]:
    named = F.sha2(F.concat(F.lit(f"{SEED}:"), F.col("vec_id").cast("string")), 256)
    chosen = rows.where("vec_id IS NOT NULL").select(named.alias("h"), "v").orderBy("h", "v").limit(count)
    return [row["v"] for row in chosen.collect()]  # at most ``count`` vectors


def _matrix(values: list[list[int]]) -> np.ndarray:
    """Whole numbers as longs, or as Python numbers where squares might not fit."""
    usual = all(abs(x) < USUAL for row in values for x in row)
    return np.array(values, dtype=np.int64 if usual else object).reshape(len(values), -1)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances, row by row."""
    if x.dtype == object or c.dtype == object:
        d = x.astype(object) - c.astype(object)
    else:
        d = x - c
    return (d * d).sum(axis=-1)


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances of every row to every point, as doubles."""
    return np.stack([np.sqrt(squared(x, p[None]).astype(np.float64)) for p in points], axis=1)


def nearest(x: np.ndarray, table: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(centroid, squared distance) of every row by bounds from the pivot table."""
    by_pivot = distances(centroids, pivots)
    low = np.zeros((len(x), len(centroids)))
    for p in range(len(pivots)):
        np.maximum(low, np.abs(table[:, p, None] - by_pivot[None, :, p]), out=low)
    scale = max(1.0, float(table.max(initial=0)), float(by_pivot.max(initial=0)))
    low = np.maximum(0, low - scale * 1e-12) ** 2 * (1 - 1e-12)  # below the true squared distance
    order = np.argsort(low, axis=1, kind="stable")
    best = np.full(len(x), -1, dtype=np.int64)
    cost = np.zeros(len(x), dtype=object if x.dtype == object or centroids.dtype == object else np.int64)
    open_rows = np.arange(len(x))
    for step in range(len(centroids)):
        c = order[open_rows, step]
        if step:  # bounds rise along the order, so a row that is done stays done
            going = low[open_rows, c] <= cost[open_rows].astype(np.float64) * (1 + 1e-12)
            open_rows, c = open_rows[going], c[going]
        if not len(open_rows):
            break
        exact = squared(x[open_rows], centroids[c])
        better = (best[open_rows] < 0) | (exact < cost[open_rows]) | ((exact == cost[open_rows]) & (c < best[open_rows]))
        hit = open_rows[better]
        best[hit], cost[hit] = c[better], exact[better]
    return best, cost


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("v")
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, DIMS)
    wide = len(flat) and not (-USUAL < flat.min() and flat.max() < USUAL)
    return flat.astype(object) if wide else flat


def _table(batch: pa.RecordBatch, pivots: int) -> np.ndarray:
    return batch.column("t").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, pivots)


def with_pivot_distances(rows: DataFrame, pivots: list[list[int]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = _matrix(pivots)
        for batch in batches:
            if batch.num_rows:
                t = distances(_vectors(batch), points)
                flat = pa.FixedSizeListArray.from_arrays(pa.array(t.reshape(-1)), len(points)).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), flat], names=["vec_id", "v", "t"])

    return rows.mapInArrow(run, "vec_id bigint, v array<bigint>, t array<double>")


def moved(rows: DataFrame, centroids: list[list[int]], pivots: list[list[int]]) -> list[list[int]]:
    """The centroids after one round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, p = _matrix(centroids), _matrix(pivots)
        count = [0] * len(c)
        total = [[0] * DIMS for _ in c]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _vectors(batch)
            best, _ = nearest(x, _table(batch, len(p)), c, p)
            for k in np.unique(best).tolist():
                mine = x[best == k]
                count[k] += len(mine)
                total[k] = [a + int(b) for a, b in zip(total[k], mine.sum(axis=0))]
        ids = [k for k in range(len(c)) if count[k]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int32()), pa.array([count[k] for k in ids], pa.int64()), pa.array([[str(s) for s in total[k]] for k in ids], pa.list_(pa.string()))],
            names=["cluster", "n", "sums"],
        )

    parts = rows.mapInArrow(run, "cluster int, n bigint, sums array<string>")
    each = F.posexplode(F.transform("sums", lambda s: s.cast("decimal(38,0)"))).alias("dim", "part")
    sums = parts.select("cluster", "n", each).groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum("part").alias("total"))
    after = [list(c) for c in centroids]
    for row in sums.collect():  # a row for each centroid and component
        after[row["cluster"]][row["dim"]] = int(row["total"]) // row["n"]
    return after


def assigned(rows: DataFrame, centroids: list[list[int]], pivots: list[list[int]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, p = _matrix(centroids), _matrix(pivots)
        for batch in batches:
            if batch.num_rows:
                best, cost = nearest(_vectors(batch), _table(batch, len(p)), c, p)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(best.astype(np.int32)), pa.array([int(x) for x in cost], pa.int64())],
                    names=["vec_id", "cluster", "distance"],
                )

    return rows.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def clustered(vectors: DataFrame) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every kept vector."""
    spark = vectors.sparkSession
    rows = stage(kept(vectors), "whole-vectors")
    pivots = first_centroids(rows)
    if not pivots:
        return spark.createDataFrame(
            [], "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        )
    rows = stage(with_pivot_distances(rows, pivots), "pivot-table")
    centroids = pivots
    for _ in range(ROUNDS):
        centroids = moved(rows, centroids, pivots)
    found = stage(assigned(rows, centroids, pivots), "assigned")
    per_cluster = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    sums = {row["cluster"]: int(row["s"]) for row in per_cluster.collect()}  # a row for each centroid
    named = [
        (k, sums.get(k, 0), sum(sums.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for k, c in enumerate(centroids)
    ]
    known = spark.createDataFrame(named, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
