"""Operator 11, centroid clustering by a tournament of bisectors, in whole numbers.

A vector's components x become floor(scale * x). Between two centroids i < j lies a bisector: with the normal
2 (c_i - c_j) and the threshold |c_i|^2 - |c_j|^2, the vector v is on the side of i when normal . v - threshold is
zero or more. So the nearest centroid needs no distances: a vector starts with centroid 0, meets 1, 2, ... in turn,
and after k - 1 sign tests the last winner is the nearest, the smaller number among equally near ones. Only the
winner's distance is then worked out, from the difference itself.

The integer vectors are written once. Each round reads them, and every task sends one row of count and sums for
each centroid it met; their totals (k x dims numbers) are all that reaches the driver, which holds the centroids.

Arithmetic is exact: on float64 where no sum can reach 2^53, on Python integers beyond that. Components of 2^21 and
more in magnitude, or distances beyond a long, are an error rather than a wrong result.

Defined results: vectors that are null, of another number of components, or with null or non-finite components are
left out; repeated rows and ids are vectors of their own; a null id ranks last when the first centroids are chosen, and
ties of equal ids go by the components; with fewer vectors than k there are as many centroids as vectors; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

DIMS, CENTROIDS, ROUNDS, SCALE = 64, 8, 10, 1024
#: Below this, float64 holds every whole number.
EXACT = 1 << 53
#: Vectors worked on together.
ROWS = 4096


def integer_vectors(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", dims: int = DIMS,
                    scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``v`` (little-endian 32-bit integers) of every usable vector."""
    whole = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    usable = rows.select(F.col(id_column).alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v")).where(
        F.coalesce((F.size("v") == dims) & whole, F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scaled = np.floor(scale * batch.column("v").flatten().to_numpy(zero_copy_only=False))
            if len(scaled) and np.abs(scaled).max() >= 1 << 31:
                raise ValueError("a component is too large for exact distances in a long")
            data = scaled.astype("<i4").tobytes()
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * (4 * dims)
            packed = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), packed], ["vec_id", "v"])

    return usable.mapInArrow(run, f"vec_id {rows.schema[id_column].dataType.simpleString()}, v binary")


def _numbers(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, dims)


class Bisectors:
    """Normals and thresholds between centroids (rows of Python integers), and the tournament on them."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = np.asarray(centroids, object)
        k = len(centroids)
        self.normal = 2 * (self.centroids[:, None] - self.centroids[None])
        square = (self.centroids ** 2).sum(axis=1)
        self.threshold = square[:, None] - square[None]
        self.rivals = range(1, k)

    def _kind(self, v: np.ndarray):
        """float64 if no intermediate sum can reach 2^53, else Python integers."""
        largest = int(max(np.abs(v.astype(np.int64)).max(initial=0), np.abs(self.centroids).max(initial=0)))
        return np.float64 if 8 * v.shape[1] * largest * largest < EXACT else object

    def nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each vector's nearest centroid, and the squared distance to it."""
        kind = self._kind(v)
        normal, threshold, centroids = (x.astype(kind) for x in (self.normal, self.threshold, self.centroids))
        winner, distance = np.zeros(len(v), np.int64), np.zeros(len(v), np.int64)
        for start in range(0, len(v), ROWS):
            part = v[start:start + ROWS].astype(kind)
            best = winner[start:start + ROWS]
            for rival in self.rivals:
                side = (part * normal[best, rival]).sum(axis=1) - threshold[best, rival]
                best[side < 0] = rival
            distance[start:start + ROWS] = ((part - centroids[best]) ** 2).sum(axis=1)
        return winner, distance


def _first_centroids(vectors: DataFrame, k: int, dims: int, seed: int) -> list[list[int]]:
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = vectors.select(key.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    return [np.frombuffer(r.v, "<i4").tolist() for r in chosen]


def _moved(vectors: DataFrame, centroids: list[list[int]], dims: int) -> list[list[int]]:
    """The centroids after one round: floors of their vectors' means; those without vectors stay."""
    bisectors, k = Bisectors(centroids), len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            v = _numbers(batch.column("v"), dims)
            best, _ = bisectors.nearest(v)
            count += np.bincount(best, minlength=k)
            for c in range(k):
                total[c] += v[best == c].sum(axis=0, dtype=np.int64)
        met = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(count[met]), pa.array(total[met].tolist(), pa.list_(pa.int64()))],
                                         ["cluster", "n", "total"])

    parts = vectors.select("v").mapInArrow(run, "cluster int, n long, total array<long>")
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "x")]
    sums = parts.select("cluster", "n", F.posexplode("total").alias("place", "x")).groupBy("cluster", "place").agg(*exact).collect()
    moved = [list(c) for c in centroids]
    for r in sums:
        moved[r.cluster][r.place] = int(r.x) // int(r.n)
    return moved


def cluster(rows: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = 3, id_column: str = "vec_id",
            vector_column: str = "embedding", dims: int = DIMS, scale: int = SCALE) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id, cluster, distance`` of every usable vector after ``rounds`` rounds, and the final centroids."""
    vectors = written(integer_vectors(rows, id_column, vector_column, dims, scale), "vectors")
    centroids = _first_centroids(vectors, k, dims, seed)
    for _ in range(rounds if centroids else 0):
        moved = _moved(vectors, centroids, dims)
        if moved == centroids:  # a fixed point: further rounds would change nothing
            break
        centroids = moved
    bisectors = Bisectors(centroids) if centroids else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, distance = bisectors.nearest(_numbers(batch.column("v"), dims))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(best, pa.int32()), pa.array(distance)],
                                             ["vec_id", "cluster", "distance"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec_id {kind}, cluster int, distance long"), centroids


def report(rows: DataFrame, **settings) -> DataFrame:
    """Per vector also ``cluster_inertia``, ``inertia`` and ``centroid_sha256``; the added table has k rows at most."""
    found, centroids = cluster(rows, **settings)
    found = written(found, "clusters")
    inertia = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    whole = sum(inertia.values())
    facts = [(c, inertia.get(c, 0), whole, hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()) for c, centroid in enumerate(centroids)]
    table = rows.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
