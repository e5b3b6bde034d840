import hashlib
import math

import numpy as np
import pytest

from shelfwise.llm import clustering as op
from shelfwise.llm.common import prepare_text

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k, rounds, dims):
    kept = [(i, [math.floor(1024 * float(np.float32(c))) for c in v]) for i, v in rows
            if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]
    named = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)
    centroids = [x for _, x in named[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centroids)) for _, x in kept] if centroids else []

    for _ in range(rounds):
        at = assign()
        for j in range(len(centroids)):
            own = [x for (_, x), (_, c) in zip(kept, at) if c == j]
            if own:
                centroids[j] = [sum(col) // len(own) for col in zip(*own)]
    at = assign()
    inertia = {j: sum(d for d, c in at if c == j) for j in range(len(centroids))}
    return sorted(
        ((i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for (i, _), (d, c) in zip(kept, at)),
        key=str,
    )


def result(df):
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect()), key=str)


def test_agrees_with_plain_rounds(spark):
    prepare_text(spark)
    random = np.random.default_rng(5)
    rows = [(i, [float(c) for c in random.normal(size=6) + 3 * (i % 4)]) for i in range(300)]
    rows += [(i, list(rows[0][1])) for i in (400, 401, 400)]  # repeated rows and vectors
    rows += [(500, None), (501, []), (502, [1.0] * 5), (503, [1.0] * 5 + [None]), (504, [1.0] * 5 + [float("nan")]), (505, [float("inf")] * 6), (None, [0.5] * 6)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert result(op.cluster_vectors(df, k=5, rounds=4, dims=6)) == brute(rows, 5, 4, 6)


def test_ties_empty_clusters_and_few_vectors(spark):
    prepare_text(spark)
    rows = [(i, [float(i % 2), 0.0]) for i in range(9)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("vec_id", "embedding", "1 as cluster", "'x' as x")
    assert result(op.cluster_vectors(df, k=4, rounds=3, dims=2)) == brute(rows, 4, 3, 2)
    assert result(op.cluster_vectors(df, k=40, rounds=3, dims=2)) == brute(rows, 40, 3, 2)
    empty = op.cluster_vectors(df.filter("false"), dims=2)
    assert empty.count() == 0 and dict(empty.dtypes)["centroid"] == "array<int>"


def test_a_component_out_of_range_is_an_error(spark):
    prepare_text(spark)
    with pytest.raises(Exception, match="more than exact sums allow"):
        op.cluster_vectors(spark.createDataFrame([(1, [1e9])], SCHEMA), dims=1)


def test_walk_finds_the_nearest_and_stops_early():
    random = np.random.default_rng(2)
    centroids = random.integers(-1000, 1000, (200, 3))
    centroids[7] = centroids[3]
    vectors = np.vstack([random.integers(-1200, 1200, (500, 3)), centroids[:20]])
    lists = op.SortedCentroids(centroids)
    clusters, distances, entries = lists.nearest(vectors)
    every = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (clusters == every.argmin(axis=1)).all() and (distances == every.min(axis=1)).all()
    assert entries < 0.4 * every.size * 3
