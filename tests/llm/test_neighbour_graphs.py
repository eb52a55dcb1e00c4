import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from palate.llm import neighbour_graphs as ng
from palate.llm.common import table

SCHEMA = "vec_id bigint, embedding array<double>"


def usable(v):
    return bool(v) and all(x is not None and abs(x) <= 1e150 for x in v) and any(v)


def neighbours(rows, asks, top):
    """All candidates of every asking row, by distance and id; ``rows``: (id, vector)."""
    kept = [(i, v) for i, v in rows if usable(v)]
    out = []
    for q, (query, own) in enumerate(kept):
        if query is not None and asks(query):
            found = sorted((math.dist(own, v), i is None, i or 0, n) for n, (i, v) in enumerate(kept) if n != q and len(v) == len(own))
            out += [(query, rank, kept[n][0], round(gap, 9)) for rank, (gap, _, _, n) in enumerate(found[:top], 1)]
    return collections.Counter(out)


def result(spark, rows, step=1, **options):
    df = ng.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % step == 0, **options)
    return collections.Counter((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in df.collect())


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    return [(i, rng.normal(size=6).tolist()) for i in range(60)]


@pytest.mark.parametrize("options", [{}, {"shard_rows": 15}, {"block": 7, "shard_rows": 25}, {"top": 3}])
def test_small_tables_are_answered_exactly(spark, vectors, options):
    """Up to ``beam`` distinct vectors in a shard, the search meets all that are reachable, which is all."""
    assert result(spark, vectors, 5, **options) == neighbours(vectors, lambda i: i % 5 == 0, options.get("top", 10))


def test_what_takes_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, []), (3, [0.0, -0.0]), (4, [None, 1.0]), (5, [math.nan, 1.0]), (6, [math.inf, 1.0]),
            (7, [1.0, 2.5]), (8, [1.0]), (9, [2.0]), (None, [1.0, 2.5]), (10, [1e200, 1.0]), (11, [3.0, -0.0]), (12, [3.0, 0.0])]
    want = neighbours(rows, lambda i: True, 10)
    assert result(spark, rows) == want
    assert {q for q, *_ in want} == {0, 7, 8, 9, 11, 12}


def test_copies_repeated_rows_and_ties(spark, vectors):
    """A third of all rows is one vector; ties go to the smaller id, a row is not its own neighbour, a repeated one is."""
    rows = vectors + [(100 + i, vectors[7][1]) for i in range(30)] + [vectors[0]] * 3
    want = neighbours(rows, lambda i: i % 5 == 0, 10)
    assert result(spark, rows, 5) == want == result(spark, rows, 5, shard_rows=20)


def test_empty_tables_and_other_columns(spark):
    assert not result(spark, []) and not result(spark, [(1, None)]) and not result(spark, [(1, [1.0])])
    assert not result(spark, [(1, [1.0]), (3, [2.0])], step=2)
    df = spark.createDataFrame([(2, [1.0, 0.0], 1, 2), (3, [1.0, 1.0], 1, 2)], "`the.id` int, `a.vector` array<float>, rank int, SCORE int")
    got = ng.nearest(df, F.col("vec_id") == 2, "the.id", "a.vector").collect()
    assert [tuple(r) for r in got] == [(2, 1, 3, 1.0)]


def clustered(n, dims, centres, seed):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims))
    return middle[rng.integers(0, centres, n)] + rng.normal(size=(n, dims)) / 8


@pytest.mark.parametrize("centres", [1, 12, 300])
def test_recall_within_a_shard(centres):
    vectors = np.unique(clustered(3000, 24, centres, centres), axis=0)
    vectors = vectors[np.random.default_rng(0).permutation(len(vectors))]
    index = ng.build(vectors)
    assert index.sizes[0] == len(vectors) and len(index.sizes) > 1
    asked = vectors[::30]
    found = ng.search(index, asked)[0][:, :11]
    true = np.argsort(ng._distances(asked, vectors), axis=1)[:, :11]
    assert np.mean([len(set(a) & set(b)) / 11 for a, b in zip(found.tolist(), true.tolist())]) >= 0.95


def test_every_node_is_reachable():
    """Groups far apart, each larger than any neighbour list."""
    rng = np.random.default_rng(8)
    vectors = np.concatenate([rng.normal(size=(200, 3)) / 1000 + 100 * g for g in range(6)])
    vectors = vectors[rng.permutation(len(vectors))]
    for level in ng.build(vectors).neighbours:
        assert ng._reached(level).all()


def test_recall_over_the_given_table(spark, folder):
    got = ng.op13_nearest_vectors(spark, folder).collect()
    rows = table(spark, folder, "embeddings").collect()
    vectors = np.array([r.embedding for r in rows], np.float64)
    ids = np.array([r.vec_id for r in rows])
    found = collections.defaultdict(list)
    for r in got:
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(found) == {i for i in ids.tolist() if i % 100 == 0}
    hits = 0
    for q, own in found.items():
        own.sort()
        gaps = np.sqrt(((vectors - vectors[ids == q]) ** 2).sum(1))
        true = [ids[j] for j in np.lexsort((ids, gaps)) if ids[j] != q][:10]
        hits += len({v for _, v, _ in own} & set(true))
        assert [r for r, *_ in own] == list(range(1, 11))
        assert all(abs(s - gaps[ids == v][0]) < 1e-12 for _, v, s in own)
        assert own == sorted(own, key=lambda x: (x[2], x[1]))
    assert hits >= 9 * len(found)


def test_the_index_holds_every_row_in_flat_arrays(spark, folder):
    kept = ng.taking_part(table(spark, folder, "embeddings"))
    shards = ng.build_index(kept, 3).collect()
    assert sum(s.n_rows for s in shards) == kept.count() == 500
    for s in shards:
        index = ng.unpacked(s.asDict())
        assert len(index.vectors) == s.n_rows and len(s.ids) == 8 * s.n_rows
        assert all(len(level) == size for level, size in zip(index.neighbours, index.sizes))


def test_shards_grow_before_they_multiply():
    assert [ng.shards_of(n) for n in (0, 1, 8192, 8193, 64 * 8192, 64 * 8192 + 1, 1 << 30)] == [1, 1, 1, 2, 64, 64, 1 << 14]
