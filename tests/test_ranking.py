import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
import pyarrow as pa
from pyspark.sql import functions as F

from palate.functions import tiles
from palate.operators import als, ranking

LIST = pa.list_(pa.float32())


def factor_frame(spark, ids, matrix):
    return spark.createDataFrame([(int(i), [float(x) for x in row]) for i, row in zip(ids, matrix)],
                                 "id int, features array<float>")


def brute_force(user_ids, users, item_ids, items, seen, n):
    expected = {}
    for uid, u in zip(user_ids, users):
        scored = [(np.float32(np.dot(u.astype(np.float64), v.astype(np.float64))), int(i))
                  for i, v in zip(item_ids, items) if (int(uid), int(i)) not in seen]
        expected[int(uid)] = [i for _, i in sorted(scored, key=lambda p: (-p[0], p[1]))[:n]]
    return {u: lst for u, lst in expected.items() if lst}


def collected(df):
    lists = {}
    for row in df.orderBy("userId", "rank").collect():
        lists.setdefault(row.userId, []).append(row.movieId)
        assert row["rank"] == len(lists[row.userId])
    return lists


@pytest.mark.parametrize("tile_users, tile_items", [(65536, 65536), (7, 65536), (65536, 9), (5, 6)])
def test_lists_equal_brute_force_for_any_tiling(spark, tile_users, tile_items):
    rng = np.random.default_rng(3)
    user_ids, item_ids = np.arange(10, 50), rng.permutation(1000)[:60]
    # Small integers give many equal scores, so ties are exercised as well.
    users, items = (rng.integers(-2, 3, (len(ids), 3)).astype(np.float32) for ids in (user_ids, item_ids))
    seen = {(int(u), int(i)) for u in user_ids for i in item_ids if rng.random() < 0.2}
    seen |= {(10, int(i)) for i in item_ids}                  # rated everything: no list
    seen |= {(11, int(i)) for i in item_ids[:-2]}             # fewer candidates than asked for
    noise = [(10, 5000), (99999, int(item_ids[0])), (None, 1), (12, None)]
    history = spark.createDataFrame([*seen, *seen, *noise], "userId int, movieId int")
    got = ranking.top_n_per_user(factor_frame(spark, user_ids, users), factor_frame(spark, item_ids, items),
                                 history, 5, tile_users, tile_items)
    expected = brute_force(user_ids, users, item_ids, items, seen, 5)
    assert collected(got) == expected
    assert 10 not in expected and len(expected[11]) == 2


def test_agrees_with_the_built_in_recommender(spark, ratings):
    """The built-in lists keep seen items, so it is asked for enough to survive removing them."""
    model = als.fit(ratings, rank=4, max_iter=3)
    most = ratings.groupBy("userId").count().agg(F.max("count")).first()[0]
    built_in = (model.recommendForAllUsers(10 + most).select("userId", F.explode("recommendations").alias("r"))
                .select("userId", "r.movieId", F.col("r.rating").alias("prediction"))
                .join(ratings.select("userId", "movieId"), ["userId", "movieId"], "left_anti"))
    expected = ranking.rank_per_user(built_in, 10).select("userId", "rank", F.col("prediction").alias("p"))
    ours = ranking.top_n_per_user(model.userFactors, model.itemFactors, ratings, 10)
    both = ours.join(expected, ["userId", "rank"], "full")
    assert both.count() == ours.count() == expected.count()
    assert both.filter(~(F.abs(F.col("prediction") - F.col("p")) < 1e-5)).count() == 0


def test_restricted_items_only(spark, ratings):
    model = als.fit(ratings, rank=2, max_iter=1)
    allowed = model.itemFactors.filter("id < 20")
    lists = ranking.top_n_per_user(model.userFactors, allowed, ratings, 25)
    assert lists.filter("movieId >= 20").count() == 0
    assert lists.join(ratings, ["userId", "movieId"]).count() == 0


def test_no_items_no_lists(spark):
    users = factor_frame(spark, [1], [[1.0]])
    assert ranking.top_n_per_user(users, users.limit(0), spark.createDataFrame([], "userId int, movieId int")).count() == 0


def test_top_n_ignores_nan(frame):
    rows = frame([(1, float("nan")), (2, 1.0), (3, 2.0), (4, 2.0), (5, None)], "movieId int, prediction float")
    assert [r.movieId for r in ranking.top_n(rows, 2).collect()] == [3, 4]
    assert [r.movieId for r in ranking.top_n(rows, 9).collect()] == [3, 4, 2]
    assert [r.movieId for r in ranking.top_n(rows, 9, F.col("movieId") < 4).collect()] == [3, 2]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 6), st.integers(1, 12), st.integers(1, 8), st.integers(0, 2**32 - 1), st.sampled_from([1, 7, 1 << 22]))
def test_tile_equals_brute_force(n_users, n_items, n, seed, cells):
    rng = np.random.default_rng(seed)
    users, items = (rng.integers(-1, 2, (k, 2)).astype(np.float32) for k in (n_users, n_items))
    user_ids, item_ids = rng.permutation(100)[:n_users], rng.permutation(100)[:n_items]
    seen = {(int(u), int(i)) for u in user_ids for i in item_ids if rng.random() < 0.3}
    left = pa.table({
        "userId": pa.array([*map(int, user_ids), *(u for u, _ in seen)], pa.int32()),
        "movieId": pa.array([None] * n_users + [i for _, i in seen], pa.int32()),
        "u": pa.array([*map(list, users), *([] for _ in seen)], LIST)})
    right = pa.table({"movieId": pa.array(map(int, item_ids), pa.int32()), "v": pa.array(map(list, items), LIST)})
    kept, tiles.TILE_CELLS = tiles.TILE_CELLS, cells
    try:
        out = tiles.best_in_tile(left, right, n).to_pylist()
    finally:
        tiles.TILE_CELLS = kept
    got = {}
    for row in out:
        got.setdefault(row["userId"], []).append(row["movieId"])
    assert got == brute_force(user_ids, users, item_ids, items, seen, n)


def test_unscored_pairs_stay(frame, spark):
    factors = spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.5, 0.5])], "id int, features array<float>")
    pairs = frame([(1, 2, 1.0), (1, 9, 1.0), (9, 2, 1.0)])
    scored = ranking.score_pairs(pairs, factors, factors)
    assert sorted((r.userId, r.movieId, str(r.prediction)) for r in scored.collect()) == [
        (1, 2, "1.5"), (1, 9, "nan"), (9, 2, "nan")]


def test_a_dense_history_is_cut_into_more_tiles(spark):
    rng = np.random.default_rng(3)
    frames = [spark.createDataFrame([(i, rng.random(4).tolist()) for i in range(n)], "id int, features array<float>") for n in (40, 60)]
    seen = spark.createDataFrame([(u, i) for u in range(40) for i in range(60) if (u + i) % 7], "userId int, movieId int")

    def lists(tile_seen):
        best = ranking.top_n_per_user(*frames, seen, 5, tile_seen=tile_seen)
        tiles_used = best._jdf.queryExecution().optimizedPlan().toString()
        return {tuple(r) for r in best.collect()}, int(re.findall(r"pmod\(xxhash64\(userId#\d+, 42\), (\d+)\)", tiles_used)[0])

    (few, n_few), (many, n_many) = lists(10**9), lists(60)
    assert few == many and n_many > n_few


def test_overfetched_lists_equal_the_tiled_ones(spark, ratings):
    model = als.fit(ratings, rank=4, max_iter=3)
    tiled = ranking.top_n_per_user(model.userFactors, model.itemFactors, ratings, 7)
    fetched = ranking.top_n_by_overfetch(model, ratings, 7)
    assert collected(fetched).keys() == collected(tiled).keys()
    both = tiled.join(fetched.withColumnsRenamed({"prediction": "other", "movieId": "item"}), ["userId", "rank"], "full")
    assert both.filter("abs(prediction - other) > 1e-4 OR prediction IS NULL OR other IS NULL").count() == 0


def test_one_heavy_user_does_not_make_others_fetch_more(spark):
    """A user who has rated nearly everything, light ones, and one without any history."""
    rows = [(0, i, 3.0) for i in range(190)] + [(u, (u * 7 + k) % 200, 4.0) for u in range(1, 41) for k in range(3 + u % 5)]
    rows += [(99, 199, 1.0)]
    history = spark.createDataFrame(rows, "userId int, movieId int, rating float")
    model = als.fit(history, rank=2, max_iter=1)
    seen = history.filter("userId <> 99")
    fetched = {r.userId: r["count"] for r in ranking.overfetched(model, seen, 5).groupBy("userId").count().collect()}
    own = {r.userId: r["count"] for r in seen.groupBy("userId").count().collect()}
    assert fetched.keys() == {*own, 99} and fetched[99] == 5
    assert all(5 + own[u] <= fetched[u] <= 5 + 2 * own[u] for u in own if u) and fetched[0] >= 5 + 190 - 5
    lists = collected(ranking.top_n_by_overfetch(model, seen, 5))
    assert all(len(lists[u]) == 5 for u in fetched) and not {(u, i) for u, own in lists.items() for i in own} & {r[:2] for r in rows[:-1]}


def test_overfetch_without_users_or_history(spark, ratings):
    model = als.fit(ratings, rank=2, max_iter=1)
    nobody = ranking.overfetched(model, ratings.limit(0), 3)
    assert nobody.count() == 3 * model.userFactors.count()
    none = ranking.history_buckets(ratings.limit(0))
    assert none.columns == ["userId", "n_seen", "bucket"] and none.count() == 0


def test_a_restricted_model_lists_its_items_only(spark, ratings):
    model = als.fit(ratings, rank=3, max_iter=2)
    some = model.itemFactors.filter("id % 3 = 0").select("id")
    part = als.restricted(model, some)
    assert {r.id for r in part.itemFactors.collect()} == {r.id for r in some.collect()}
    assert part.userFactors.count() == model.userFactors.count() and part.rank == model.rank
    tiled = collected(ranking.top_n_per_user(part.userFactors, part.itemFactors, ratings, 4))
    fetched = collected(ranking.top_n_by_overfetch(part, ratings, 4))
    assert {u: len(x) for u, x in tiled.items()} == {u: len(x) for u, x in fetched.items()}
    assert all(i % 3 == 0 for own in fetched.values() for i in own)
