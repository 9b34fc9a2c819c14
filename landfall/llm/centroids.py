"""Exact centroid clustering of integer vectors, pruned by Ptolemy's inequality.

For points x, c and pivots p, q of a Euclidean space
``d(x,c) * d(p,q) >= |d(x,p) * d(c,q) - d(x,q) * d(c,p)|``. Distances of all
vectors to fixed pivots, which are the first centroids, are computed once and
stored next to the vectors. In each round a vector first meets the centroid that
began as its nearest pivot; another one is looked at only if the bound over its
pivot pairs, rounded down, does not exceed that distance. Survivors are compared by
exact integer distances, so the result is that of comparing all.

Vectors are never shuffled: tasks sum theirs per centroid, and only such sums,
which are as many as centroids and components, travel. Centroids are sent to all
tasks; their number and the length of vectors bound their size. Every round reads
the same stored table, so a lost executor repeats its own tasks only.

Only vectors of exactly ``width`` finite components take part; NULL vectors and
rows without an id do not. Rows that repeat an id are vectors of their own, and
equal rows count as often as they occur. With fewer vectors than centroids, there
are as many centroids as vectors; no vectors give no rows. Components whose
squared distances might leave 64 bits raise an error. Other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.vectors import binary_rows, doubles, from_binary, is_finite, matrix, pieces, whole_numbers
from landfall.session import materialize

# By how much a bound is lowered before it is trusted: far above the rounding of
# the few operations on doubles that lead to it.
SLACK = 1e-9

# Rows handled at once, which bounds a task's memory.
ROWS = 4096


@dataclass
class Pivots:
    """Fixed points, the pairs of them that give bounds, and the distances within pairs."""

    points: np.ndarray
    first: np.ndarray
    second: np.ndarray
    apart: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray) -> Pivots:
        """Neighbouring points in the given order as pairs; pairs of equal points give no bound."""
        n = len(points)
        first = np.arange(n)
        second = (first + 1) % max(n, 1)
        apart = np.sqrt(squared(points[first], points[second]).astype(float))
        usable = apart > 0
        return cls(points, first[usable], second[usable], apart[usable])

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Squared distances of each row to each pivot."""
        return np.stack([squared(x, p) for p in self.points], axis=1)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances between rows of integers."""
    gap = x - c
    return np.einsum("...i,...i->...", gap, gap)


def lower_bounds(to_pivots: np.ndarray, centre: np.ndarray, pivots: Pivots, own: int) -> np.ndarray:
    """For each row a number that its squared distance to a centroid never falls below.

    ``to_pivots`` holds the rows' distances to the pivots, ``centre`` those of the
    centroid. Pairs with the pivot that the centroid began as tell most, so only they are used.
    """
    pairs = np.flatnonzero((pivots.first == own) | (pivots.second == own))
    if not len(pairs):
        return np.zeros(len(to_pivots))
    p, q = pivots.first[pairs], pivots.second[pairs]
    ahead, back = to_pivots[:, p] * centre[q], to_pivots[:, q] * centre[p]
    least = (np.abs(ahead - back) - SLACK * (ahead + back)) / pivots.apart[pairs]
    least = np.maximum(least.max(axis=1), 0.0)
    return np.floor(least * least * (1 - SLACK))


def assign(
    x: np.ndarray, to_pivots: np.ndarray, before: np.ndarray, centres: np.ndarray, pivots: Pivots
) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of each row's nearest centroid (the smaller of equals), its squared distance, and how many were computed."""
    best = squared(x, centres[before])
    nearest = before.copy()
    computed = len(x)
    roots = np.sqrt(to_pivots.astype(float))
    for number, (centre, away) in enumerate(zip(centres, np.sqrt(pivots.distances(centres).astype(float)), strict=True)):
        rows = np.flatnonzero((before != number) & (lower_bounds(roots, away, pivots, number) <= best))
        computed += len(rows)
        found = squared(x[rows], centre)
        nearer = (found < best[rows]) | ((found == best[rows]) & (number < nearest[rows]))
        best[rows[nearer]] = found[nearer]
        nearest[rows[nearer]] = number
    return nearest, best, computed


def _with_pivots(vectors: DataFrame, pivots: Pivots, width: int, scale: float) -> DataFrame:
    """Each vector as integers, with its distances to the pivots."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, ROWS):
            x = whole_numbers(matrix(piece.column("vector"), width), scale)
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), binary_rows(x), binary_rows(pivots.distances(x))], ["id", "x", "to_pivots"]
            )

    return materialize(vectors.mapInArrow(rows, "id long, x binary, to_pivots binary"))


def _read(piece: pa.RecordBatch, width: int, pivots: int) -> tuple[np.ndarray, np.ndarray]:
    return (
        from_binary(piece.column("x"), np.int64, width),
        from_binary(piece.column("to_pivots"), np.int64, pivots),
    )


def _assigned(stored: DataFrame, centres: np.ndarray, pivots: Pivots, width: int) -> DataFrame:
    """Each vector's nearest centroid and its squared distance."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, ROWS):
            x, to_pivots = _read(piece, width, len(pivots.points))
            near, far, _ = assign(x, to_pivots, to_pivots.argmin(axis=1), centres, pivots)
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), pa.array(near.astype(np.int32)), pa.array(far)], ["id", "cluster", "distance"]
            )

    return stored.mapInArrow(rows, "id long, cluster int, distance long")


def _sums(stored: DataFrame, centres: np.ndarray, pivots: Pivots, width: int) -> tuple[list, list]:
    """Number of vectors and componentwise sum of every centroid's vectors."""
    k = len(centres)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Integers of any size: a task's rows are not bounded, so neither are its sums.
        count, total = np.zeros(k, dtype=np.int64), np.zeros((k, width), dtype=object)
        for piece in pieces(batches, ROWS):
            x, to_pivots = _read(piece, width, len(pivots.points))
            near, _, _ = assign(x, to_pivots, to_pivots.argmin(axis=1), centres, pivots)
            count += np.bincount(near, minlength=k)
            part = np.zeros((k, width), dtype=np.int64)
            np.add.at(part, near, x)
            total += part
        for number in np.flatnonzero(count):
            yield pa.RecordBatch.from_pydict(
                {
                    "cluster": pa.array([number] * (width + 1), pa.int32()),
                    "place": pa.array(range(-1, width), pa.int32()),
                    "total": pa.array([str(count[number]), *map(str, total[number])]),
                }
            )

    parts = stored.mapInArrow(rows, "cluster int, place int, total string")
    summed = parts.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    count, total = [0] * k, [[0] * width for _ in range(k)]
    for row in summed.collect():  # as many rows as centroids times components
        if row.place < 0:
            count[row.cluster] = int(row.total)
        else:
            total[row.cluster][row.place] = int(row.total)
    return count, total


def clustered(
    df: DataFrame,
    k: int = 16,
    rounds: int = 3,
    width: int = 64,
    scale: float = 64,
    seed: str = "1",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Id, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` of every vector.

    Components become ``floor(scale * x)``. The first centroids are the vectors whose
    ids have the smallest ``sha256("seed:id")`` (then the smallest components). Each
    round replaces every centroid that has vectors by the floor of their mean.
    """
    spark = df.sparkSession
    vectors = df.select(F.col(id_col).cast("long").alias("id"), doubles(vector_col).alias("vector"))
    vectors = vectors.filter(F.col("id").isNotNull() & is_finite(F.col("vector")) & (F.size("vector") == width))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    first = vectors.orderBy(order, "vector").limit(k).collect()  # k rows
    schema = (
        f"{id_col} long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    if not first:
        return spark.createDataFrame([], schema)
    centres = whole_numbers(np.array([row.vector for row in first], dtype=np.float64).reshape(-1, width), scale)
    pivots = Pivots.of(centres)
    stored = _with_pivots(vectors, pivots, width, scale)
    for _ in range(rounds):
        count, total = _sums(stored, centres, pivots, width)
        means = [[s // n for s in sums] if n else old for n, sums, old in zip(count, total, centres, strict=True)]
        centres = np.array(means, dtype=np.int64)
    assigned = materialize(_assigned(stored, centres, pivots, width))
    inertia = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    names = [(i, ",".join(map(str, c))) for i, c in enumerate(centres.tolist())]
    digests = spark.createDataFrame(names, "cluster int, components string")
    total = inertia.agg(F.sum("cluster_inertia").alias("inertia"))
    # One row per centroid, joined to a table that is not shuffled for it.
    summary = inertia.join(F.broadcast(digests), "cluster").select(
        "cluster",
        "cluster_inertia",
        F.lit(total.first()[0]).cast("long").alias("inertia"),
        F.sha2(F.col("components").cast("binary"), 256).alias("centroid_sha256"),
    )
    return assigned.join(F.broadcast(summary), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
