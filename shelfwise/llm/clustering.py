"""Centroid clustering in exact integers; the nearest centroid is found by the threshold algorithm."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import stored
from shelfwise.llm.vectors import exact_sums, integer_vectors, matrix

CLUSTERS, ROUNDS, DIMS, SEED = 8, 10, 64, 3
# Vectors walked at once: bounds what a worker holds, whatever the size of a batch.
WALKED = 1024


class SortedCentroids:
    """Centroids filed by value in one sorted list for each dimension.

    A vector walks every list outward from its own value, one centroid a step, the closer side first. Centroids met for
    the first time get their exact distance. A centroid not met yet is in every dimension at least as far away as the
    walk's frontier, so the walk ends once the frontiers' squared distances add up to strictly more than the best
    distance; up to there an equally near centroid of a smaller number may still turn up.
    """

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable")
        self.values = np.take_along_axis(centroids, self.order, axis=0)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of each vector's nearest centroid, and how many list entries were read."""
        found = [self._walk(vectors[i : i + WALKED]) for i in range(0, len(vectors), WALKED)]
        clusters, distances = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in (0, 1))
        return clusters, distances, sum(f[2] for f in found)

    def _walk(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        (n, dims), k = vectors.shape, len(self.centroids)
        right = np.stack([np.searchsorted(self.values[:, d], vectors[:, d]) for d in range(dims)], axis=1)
        left, columns = right - 1, np.arange(dims)
        far = np.iinfo(np.int64).max
        best, number = np.full(n, far), np.full(n, k)
        met = np.zeros((n, k), bool)
        open_rows, entries = np.arange(n), 0
        for _ in range(k):
            v, low, high = vectors[open_rows], left[open_rows], right[open_rows]
            below = np.where(low >= 0, v - self.values[np.maximum(low, 0), columns], far)
            above = np.where(high < k, self.values[np.minimum(high, k - 1), columns] - v, far)
            down = below <= above
            ids = self.order[np.where(down, low, high), columns]
            left[open_rows], right[open_rows] = low - down, high + ~down
            entries += ids.size

            reached = np.zeros((len(open_rows), k), bool)
            reached[np.arange(len(open_rows))[:, None], ids] = True
            rows, centroids = np.nonzero(reached & ~met[open_rows])
            met[open_rows] |= reached
            distance = np.full(reached.shape, far)
            distance[rows, centroids] = ((v[rows] - self.centroids[centroids]) ** 2).sum(axis=1)
            winner = distance.argmin(axis=1)
            nearest = distance[np.arange(len(open_rows)), winner]
            better = (nearest < best[open_rows]) | ((nearest == best[open_rows]) & (winner < number[open_rows]))
            best[open_rows[better]], number[open_rows[better]] = nearest[better], winner[better]

            frontier = (np.minimum(below, above) ** 2).sum(axis=1)
            open_rows = open_rows[frontier <= best[open_rows]]
            if not len(open_rows):
                break
        return number, best, entries


def cluster_vectors(
    vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, seed: int = SEED,
    vec_id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid (integers) and its SHA-256.

    Kept are vectors of exactly `dims` components, none of them null or non-finite; null vectors and all others give
    no row. Components count as floor(1024 * c). The k vectors whose ids have the smallest hashes are the first
    centroids; with fewer vectors than k, all are. Each round gives every vector to the nearest centroid (of equally
    near ones the smaller number) and moves each centroid that has vectors to the floor of their mean.

    Repeated rows count as often as they occur; of equal ids, the smaller vector starts first. Rows without an id are
    clustered like any other, but never start a cluster. An empty table gives an empty result; other columns of the
    input, whatever their names, are not read. All sums are exact. What reaches the driver is k * (dims + 1) sums a
    round, whatever the input.
    """
    kept = integer_vectors(vectors, dims, vec_id, embedding)
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = kept.select(name.alias("name"), "x").filter("name is not null").orderBy("name", "x").limit(k).collect()
    centroids = np.array([r["x"] for r in first], np.int64).reshape(-1, dims)
    if not len(first):
        return kept.select("vec_id").limit(0).select(
            "vec_id", *[F.lit(None).cast(t).alias(c) for c, t in _RESULT.items()]
        )
    for _ in range(rounds):
        centroids = _moved(kept, centroids)
    assigned = stored(_assigned(kept, SortedCentroids(centroids)), "clusters")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    by_cluster = {r["cluster"]: int(r["inertia"]) for r in sums}
    about = [
        (c, by_cluster.get(c, 0), sum(by_cluster.values()), [int(v) for v in row], hashlib.sha256(",".join(map(str, row)).encode()).hexdigest())
        for c, row in enumerate(centroids)
    ]
    known = kept.sparkSession.createDataFrame(
        about, "cluster int, cluster_inertia long, inertia long, centroid array<int>, centroid_sha256 string"
    )
    # One row a cluster: k rows of fixed size.
    return assigned.join(F.broadcast(known), "cluster").select("vec_id", *_RESULT)


_RESULT = {
    "cluster": "int", "distance": "long", "cluster_inertia": "long", "inertia": "long", "centroid": "array<int>", "centroid_sha256": "string",
}


def _moved(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round."""
    k, dims = centroids.shape
    lists = SortedCentroids(centroids)

    def sums(x: np.ndarray) -> np.ndarray:
        clusters, _, _ = lists.nearest(x)
        total = np.zeros((k, dims + 1), np.int64)
        np.add.at(total, clusters, np.hstack([x, np.ones((len(x), 1), np.int64)]))
        return total.reshape(-1)

    total = np.array(exact_sums(kept, dims, k * (dims + 1), sums), dtype=object).reshape(k, dims + 1)
    means = [[int(s) // int(row[-1]) for s in row[:-1]] if row[-1] else old.tolist() for row, old in zip(total, centroids)]
    return np.array(means, np.int64)


def _assigned(kept: DataFrame, lists: SortedCentroids) -> DataFrame:
    dims = lists.centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clusters, distances, _ = lists.nearest(matrix(batch, dims))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(clusters, pa.int32()), pa.array(distances, pa.int64())], names=["vec_id", "cluster", "distance"]
            )

    schema = f"vec_id {kept.schema['vec_id'].dataType.simpleString()}, cluster int, distance long"
    return kept.mapInArrow(run, schema)
