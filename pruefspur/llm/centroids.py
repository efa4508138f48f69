"""Clustering around centroids, filtered by n-simplex projection.

The distances of a vector to a few pivots determine, up to what the pivots cannot see, where it lies:
it is the apex of a simplex over them.  The apex coordinates are computed once per vector.  Between
two apexes the plain distance bounds the true one from below, and the distance with one altitude
mirrored bounds it from above, so most centroids are ruled out in a few dimensions; the rest are
compared in whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..hadoop import fresh_folder

DIMENSIONS, CLUSTERS, ROUNDS, SCALE, SEED, PIVOTS = 64, 16, 3, 64, 1, 8
#: Whole components up to this size keep every distance and sum within 64 bits.
LARGEST = 1 << 27
#: A pivot is used when its altitude over the others is at least this share of the largest distance.
_ALTITUDE = 0.1
#: What the bounds give way for rounding, as a share of the squared distances to the first pivot.
_SLACK = 1e-6


def _distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole vectors to one."""
    off = points - to
    return np.einsum("ij,ij->i", off, off)


@dataclass(frozen=True)
class Simplex:
    """Pivots whose base vertices are the rows of ``base``: vertex i has i coordinates, the last one
    its altitude over the vertices before it."""

    pivots: np.ndarray
    base: np.ndarray

    def apexes(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Apex coordinates of whole vectors, the altitude last, and their squared distances to the first
        pivot; without a pivot there are no coordinates."""
        p = len(self.pivots)
        if not p:
            return np.zeros((len(points), 0)), np.zeros(len(points))
        squared = np.stack([_distances(points, v) for v in self.pivots], axis=1).astype(float)
        out = np.zeros((len(points), p))
        for i in range(1, p):
            vertex = self.base[i]
            known = out[:, : i - 1] @ vertex[: i - 1]
            out[:, i - 1] = ((squared[:, 0] - squared[:, i] + vertex @ vertex) / 2 - known) / vertex[i - 1]
        out[:, p - 1] = np.sqrt(np.maximum(squared[:, 0] - (out[:, : p - 1] ** 2).sum(axis=1), 0))
        return out, squared[:, 0]


def simplex(candidates: np.ndarray, pivots: int = PIVOTS) -> Simplex:
    """Pivots among the candidates: the first one, and then always the one of the highest altitude
    over those taken, as long as it stands out."""
    made = Simplex(candidates[:1], np.zeros((min(1, len(candidates)), 0)))
    widest = float(max((_distances(candidates, c).max() for c in candidates), default=0))
    while 0 < len(made.pivots) < pivots:
        apexes, _ = made.apexes(candidates)
        best = int(apexes[:, -1].argmax())
        if apexes[best, -1] ** 2 <= _ALTITUDE**2 * widest:
            break
        base = np.pad(made.base, ((0, 1), (0, 1)))
        base[-1] = apexes[best]
        made = Simplex(np.vstack([made.pivots, candidates[best]]), base)
    return made


def nearest(
    points: np.ndarray, apexes: np.ndarray, size: np.ndarray, centroids: np.ndarray, frame: Simplex
) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of each vector (of equals the first) and its squared distance, and how
    many distances had to be computed."""
    theirs, their_size = frame.apexes(centroids)
    n, k = len(points), len(centroids)
    low, high = np.zeros((n, k)), np.full((n, k), np.inf)
    if apexes.shape[1]:
        for c in range(k):
            base = ((apexes[:, :-1] - theirs[c, :-1]) ** 2).sum(axis=1)
            slack = _SLACK * (1 + size + their_size[c])
            low[:, c] = base + (apexes[:, -1] - theirs[c, -1]) ** 2 - slack
            high[:, c] = base + (apexes[:, -1] + theirs[c, -1]) ** 2 + slack
    open_ = low <= high.min(axis=1, keepdims=True)
    best = np.zeros(n, np.int64)
    distance = np.full(n, np.iinfo(np.int64).max)
    for c in range(k):
        rows = np.flatnonzero(open_[:, c])
        found = _distances(points[rows], centroids[c])
        nearer = found < distance[rows]
        best[rows[nearer]] = c
        distance[rows[nearer]] = found[nearer]
    return best, distance, int(open_.sum())


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.reshape(-1), kind))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def whole_vectors(
    column: pa.ListArray, dimensions: int, scale: int
) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors of a column are kept, and floor(scale * x) of their components."""
    sizes = np.asarray(column.value_lengths().fill_null(-1))
    right = np.flatnonzero(sizes == dimensions)
    flat = column.take(pa.array(right)).flatten()
    made = flat.to_numpy(zero_copy_only=False).astype(float).reshape(len(right), dimensions)
    # A null component has come out as NaN.
    with np.errstate(over="ignore", invalid="ignore"):
        made = np.floor(scale * made)
        fine = (np.abs(made) <= LARGEST).all(axis=1)
    return right[fine], made[fine].astype(np.int64)


def _kept(dimensions: int, scale: int, frame: Simplex | None) -> Callable:
    """Whole vectors, and with a simplex their apexes too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, made = whole_vectors(batch.column(1), dimensions, scale)
            columns = [batch.column(0).take(pa.array(rows)), _lists(made, pa.int32())]
            names = ["_id", "whole"]
            if frame is not None:
                apexes, size = frame.apexes(made)
                columns += [_lists(apexes, pa.float64()), pa.array(size)]
                names += ["apex", "size"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _judged(batch: pa.RecordBatch, centroids: np.ndarray, frame: Simplex) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    points = _matrix(batch.column(1), centroids.shape[1]).astype(np.int64)
    apexes = _matrix(batch.column(2), len(frame.pivots))
    best, distance, _ = nearest(points, apexes, batch.column(3).to_numpy(), centroids, frame)
    return points, best, distance


def _moved(projected: DataFrame, centroids: np.ndarray, frame: Simplex) -> np.ndarray:
    """The centroids after a round: sums of each task's vectors, added up per cluster and component."""
    k, width = centroids.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The first column counts.
        total = np.zeros((k, width + 1), np.int64)
        for batch in batches:
            points, best, _ = _judged(batch, centroids, frame)
            total[:, 0] += np.bincount(best, minlength=k)
            np.add.at(total[:, 1:], best, points)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k)), _lists(total, pa.int64())], names=["cluster", "sums"])

    parts = projected.mapInArrow(summed, "cluster bigint, sums array<bigint>")
    cells = parts.select("cluster", F.posexplode("sums")).groupBy("cluster", "pos").agg(F.sum("col").alias("n"))
    out = [[0] * (width + 1) for _ in range(k)]
    for r in cells.collect():
        out[r["cluster"]][r["pos"]] = r["n"]
    return np.array(
        [[s // row[0] for s in row[1:]] if row[0] else old.tolist() for row, old in zip(out, centroids, strict=True)],
        np.int64,
    )


def cluster(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dimensions: int = DIMENSIONS,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: int = SEED,
    pivots: int = PIVOTS,
) -> DataFrame:
    """Per kept vector the id, ``cluster``, ``distance`` (squared, of whole components), the sums
    ``cluster_inertia`` and ``inertia``, and ``centroid_sha256``.

    Kept are vectors of ``dimensions`` components, none null or not finite; one with a component
    beyond 2**27 in size once scaled is left out, since its distances leave 64 bits.  Centroids start
    as the vectors of the smallest hashes of their ids (a null id is hashed as an empty one), equal
    hashes in the order of the components; fewer vectors make fewer clusters.  A vector goes to the
    nearest centroid, of equally near ones to the first.  Repeated rows are vectors of their own.
    Other columns are not read.  An empty table gives an empty result.  The driver holds centroids, and sums per cluster.
    """
    spark = vectors.sparkSession
    work = vectors.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("_v"))
    kind = dict(work.dtypes)["_id"]
    plain = work.mapInArrow(_kept(dimensions, scale, None), f"_id {kind}, whole array<int>")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit("")))
    first = plain.select(F.sha2(name.cast("binary"), 256).alias("_hash"), "whole").orderBy("_hash", "whole").limit(clusters)
    centroids = np.array([r["whole"] for r in first.collect()], np.int64).reshape(-1, dimensions)
    frame = simplex(centroids, pivots)
    folder = fresh_folder(spark, "centroids")
    work.mapInArrow(
        _kept(dimensions, scale, frame), f"_id {kind}, whole array<int>, apex array<double>, size double"
    ).write.parquet(f"{folder}/projected")
    projected = spark.read.parquet(f"{folder}/projected")
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(projected, centroids, frame)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, best, distance = _judged(batch, centroids, frame)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best, pa.int32()), pa.array(distance)], names=["_id", "cluster", "distance"]
            )

    projected.mapInArrow(assigned, f"_id {kind}, cluster int, distance bigint").write.parquet(f"{folder}/assigned")
    found = spark.read.parquet(f"{folder}/assigned")
    sums = {r["cluster"]: r["n"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    return found.select(F.col("_id").alias(id_col), "cluster", "distance").withColumns(
        {
            "cluster_inertia": _per_cluster(sums, "bigint"),
            "inertia": F.lit(sum(sums.values())).cast("bigint"),
            "centroid_sha256": _per_cluster({i: _digest(c) for i, c in enumerate(centroids)}, "string"),
        }
    )


def _digest(centroid: Sequence[int]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def _per_cluster(values: dict, kind: str):
    """A constant per cluster: there are as many as clusters, not as vectors."""
    if not values:
        return F.lit(None).cast(kind)
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("cluster")].cast(kind)
