import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from palate.llm import centroid_clusters as cc
from palate.sources import tables

SCHEMA = "vec_id bigint, embedding array<double>"


def clustered(rows, k, rounds, dims):
    """Plain rounds over all vectors and all centroids; ``rows``: (id, vector)."""
    kept = [(i, tuple(math.floor(1024 * x) for x in v)) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    hashed = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in hashed[:k]]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    place = lambda v: min((gap(v, c), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(place(v)[1], []).append(v)
        centroids = [tuple(sum(x) // len(groups[n]) for x in zip(*groups[n])) if n in groups else c for n, c in enumerate(centroids)]
    placed = [(i, *place(v)) for i, v in kept]
    inertia = {n: sum(d for _, d, m in placed if m == n) for n in range(len(centroids))}
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest())
                   for i, d, n in placed), key=str)


def result(spark, rows, **options):
    return sorted(map(tuple, cc.cluster(spark.createDataFrame(rows, SCHEMA), **options).collect()), key=str)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(5, 4))
    return [(i, (centres[i % 5] + rng.normal(size=4) / 4).tolist()) for i in range(120)]


@pytest.mark.parametrize("k, rounds", [(1, 1), (3, 2), (8, 4), (40, 3)])
def test_against_brute_force(spark, vectors, k, rounds):
    assert result(spark, vectors, k=k, rounds=rounds, dims=4) == clustered(vectors, k, rounds, 4)


def test_what_takes_no_part(spark):
    rows = [(1, [0.5, 1.0]), (2, None), (3, []), (4, [1.0]), (5, [None, 1.0]), (6, [math.nan, 1.0]), (7, [math.inf, 0.0]), (8, [0.0, 0.0]),
            (None, [2.0, 2.0]), (None, [2.0, 2.0]), (1, [0.5, 1.0]), (9, [-0.0004, -3.7])]
    assert result(spark, rows, k=3, rounds=2, dims=2) == clustered(rows, 3, 2, 2)
    assert result(spark, [(1, [2.0**17, 0.0]), (2, [1.0, 1.0])], k=2, rounds=1, dims=2) == clustered([(2, [1.0, 1.0])], 2, 1, 2)


def test_few_equal_or_no_vectors(spark):
    assert result(spark, [(2, None)], k=3, dims=2) == [] == result(spark, [], k=3, dims=2)
    alike = [(i, [1.0, 2.0]) for i in range(9)]
    got = result(spark, alike, k=4, rounds=2, dims=2)
    assert got == clustered(alike, 4, 2, 2) and {r[1] for r in got} == {0}
    assert result(spark, alike[:2], k=4, rounds=2, dims=2) == clustered(alike[:2], 4, 2, 2)


def test_a_third_of_the_rows_alike(spark, vectors):
    rows = vectors + [(1000 + i, vectors[0][1]) for i in range(60)]
    assert result(spark, rows, k=8, rounds=3, dims=4) == clustered(rows, 8, 3, 4)


def test_other_columns(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 5, 6)], "`the.id` int, `a.vector` array<float>, cluster int, DISTANCE int")
    got = cc.cluster(df, "the.id", "a.vector", k=2, rounds=1, dims=2)
    assert got.schema["vec_id"].dataType.simpleString() == "int" and got.select("cluster", "distance").collect() == [(0, 0)]


def test_too_many_centroids_are_refused(spark):
    with pytest.raises(ValueError):
        cc.cluster(spark.createDataFrame([], SCHEMA), k=cc.MAX_CENTROIDS + 1)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 5), st.integers(1, 3), st.integers(0, 9), st.integers(0, 10**6))
def test_the_tree_finds_what_comparing_all_finds(n, dims, leaf, spread, seed):
    """Small ranges make ties and equal centroids; the smaller number wins each."""
    rng = np.random.default_rng(seed)
    centroids = rng.integers(-spread, spread + 1, (n, dims))
    vectors = rng.integers(-spread - 2, spread + 3, (50, dims))
    gaps = ((vectors[:, None] - centroids[None]) ** 2).sum(-1)
    number, distance = cc.search(cc.build(centroids, leaf), vectors)
    assert number.tolist() == gaps.argmin(1).tolist() and distance.tolist() == gaps.min(1).tolist()


def test_the_tree_prunes():
    """Far apart groups of centroids: a vector looks at few of them."""
    rng = np.random.default_rng(2)
    centroids = (rng.integers(0, 16, (256, 1)) * 10_000 + rng.integers(0, 50, (256, 4))).astype(np.int64)
    tree, looked = cc.build(centroids), []
    squared, cc.squared = cc.squared, lambda a, b: looked.append(len(a)) or squared(a, b)
    try:
        cc.search(tree, centroids)
    finally:
        cc.squared = squared
    assert sum(looked) < 256 * 256 / 3


def test_large_components_stay_exact():
    centroids = np.array([[cc.LIMIT - 1] * 64, [1 - cc.LIMIT] * 64, [cc.LIMIT - 2] + [cc.LIMIT - 1] * 63])
    number, distance = cc.search(cc.build(centroids, 1), centroids[[1, 2]])
    assert number.tolist() == [1, 2] and distance.tolist() == [0, 0]
    gap = cc.squared(centroids[:1], centroids[1])
    assert gap[0] == 64 * (2 * cc.LIMIT - 2) ** 2 > 0


def test_vectors_are_not_shuffled(spark, folder, monkeypatch):
    """Only sums leave a task: below the one aggregate of a round there is no exchange of vectors."""
    plans = []
    plain = cc.next_centroids

    def watched(centroids, sums):
        plans.append(sums._jdf.queryExecution().executedPlan().toString())
        return plain(centroids, sums)

    monkeypatch.setattr(cc, "next_centroids", watched)
    cc.cluster(tables.table(spark, folder, "embeddings"), rounds=1)
    assert plans and "Exchange" not in plans[0]
