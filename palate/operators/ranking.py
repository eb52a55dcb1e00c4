"""Scoring with given factors and top-N lists, for one user or for all of them."""

from __future__ import annotations

import math

from pyspark import cloudpickle
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame, Window, functions as F

from palate.functions import tiles
from palate.functions.vectors import dot
from palate.operators.evaluate import is_scored
from palate.session import settle

TILE_USERS = 65536
TILE_ITEMS = 65536
TILE_SEEN = 4_000_000
TASKS_PER_CORE = 32

# Workers receive the tile code itself, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(tiles)


def score_pairs(pairs: DataFrame, user_factors: DataFrame, item_factors: DataFrame) -> DataFrame:
    """Attach ``prediction`` to every pair; NaN where the user or the item has no factors.

    No pair is lost, so callers can count the unscored ones; ``drop_cold`` removes them.
    """
    users = user_factors.select(F.col("id").alias("userId"), F.col("features").alias("_u"))
    items = item_factors.select(F.col("id").alias("movieId"), F.col("features").alias("_v"))
    prediction = F.coalesce(dot(F.col("_u"), F.col("_v")).cast("float"), F.lit(float("nan")).cast("float"))
    return (pairs.join(users, "userId", "left").join(items, "movieId", "left")
            .withColumn("prediction", prediction).drop("_u", "_v"))


def score_pool(model: ALSModel, pool: DataFrame, user_id: int) -> DataFrame:
    """Predict one user's candidate pool, leaving out items the model cannot score."""
    return score_pool_with(model.userFactors, model.itemFactors, pool, user_id)


def score_pool_with(user_factors: DataFrame, item_factors: DataFrame, pool: DataFrame, user_id: int) -> DataFrame:
    """The same with any factor tables.

    The pool meets the item factors in an equi-join on the key the pool is
    already partitioned by. The user's own factors are a single row and enter
    as a scalar subquery, so nothing is shuffled on the one user id.
    """
    items = item_factors.select(F.col("id").alias("movieId"), F.col("features").alias("_v"))
    own = user_factors.filter(F.col("id") == user_id).select("features").scalar()
    known = pool.join(items, "movieId").withColumn("_u", own).filter(F.col("_u").isNotNull())
    return known.withColumn("prediction", dot(F.col("_u"), F.col("_v")).cast("float")).drop("_u", "_v")


def top_n(scored: DataFrame, n: int = 25, where: Column | None = None) -> DataFrame:
    """The ``n`` highest predictions, optionally within a filter such as a genre.

    NaN would sort above every number, so it is ordered last and removed after
    the cut; filtering first would make Spark compute each prediction twice.
    """
    rows = scored if where is None else scored.filter(where)
    best_first = F.nanvl("prediction", F.lit(None).cast("float")).desc_nulls_last()
    return rows.orderBy(best_first, "movieId").limit(n).filter(is_scored())


def rank_per_user(scored: DataFrame, n: int) -> DataFrame:
    """Number each user's rows by prediction and keep ``n``.

    Filtering the row number directly lets Spark cut every partition to ``n``
    rows per user before the shuffle.
    """
    order = Window.partitionBy("userId").orderBy(F.desc("prediction"), "movieId")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def top_n_per_user(user_factors: DataFrame, item_factors: DataFrame, seen: DataFrame, n: int = 25,
                   tile_users: int = TILE_USERS, tile_items: int = TILE_ITEMS,
                   tile_seen: int = TILE_SEEN) -> DataFrame:
    """Top ``n`` unseen items of every user: ``(userId, rank, movieId, prediction)``.

    Users and items are hashed into blocks, and one task handles one block pair
    (a tile) with a matrix product, blanks the tile's seen pairs and emits at
    most ``n`` rows per user. Pairs are never stored or shuffled: what moves is
    one copy of each user per item block, one copy of each item per user block,
    the seen pairs once (they are written, two ids each), and ``n`` rows per user and item block at the end.
    A tile holds at most about ``tile_users`` users, ``tile_items`` items and
    ``tile_seen`` seen pairs, and a user or item with a huge history is spread over
    all its tiles. To serve some users or recommend from some items only,
    restrict ``user_factors`` / ``item_factors`` (and ``seen`` likewise) beforehand.
    """
    parallelism = user_factors.sparkSession.sparkContext.defaultParallelism
    # Counted and then read by the tiles; what ``seen`` is made of is computed once.
    pairs = settle(seen.select("userId", "movieId").filter(F.col("userId").isNotNull() & F.col("movieId").isNotNull()).distinct())
    n_users, n_items, n_seen = user_factors.count(), item_factors.count(), pairs.count()
    item_blocks = max(1, math.ceil(n_items / tile_items))
    # Small inputs are still cut finely enough to occupy every core, as long as the
    # copies of the items, one for each user block, do not outnumber the other rows.
    occupy = min(2 * parallelism, n_users, max(1, (n_users + n_seen) // max(1, n_items)))
    user_blocks = max(1, math.ceil(n_users / tile_users), math.ceil(n_seen / (tile_seen * item_blocks)),
                      occupy // item_blocks)

    user_block = F.pmod(F.xxhash64("userId"), F.lit(user_blocks)).cast("int").alias("ub")
    item_block = F.pmod(F.xxhash64("movieId"), F.lit(item_blocks)).cast("int").alias("ib")
    every_item_block = F.explode(F.sequence(F.lit(0), F.lit(item_blocks - 1))).alias("ib")
    every_user_block = F.explode(F.sequence(F.lit(0), F.lit(user_blocks - 1))).alias("ub")

    # Users and seen pairs travel together; a user row has no item, a seen pair an
    # empty vector (null vectors are several times slower to hand to Python).
    users = (user_factors.select(F.col("id").alias("userId"), F.col("features").alias("u"))
             .select(user_block, every_item_block, "userId", F.lit(None).cast("int").alias("movieId"), "u"))
    history = (pairs
               .select(user_block, item_block, "userId", "movieId", F.array().cast("array<float>").alias("u")))
    items = (item_factors.select(F.col("id").alias("movieId"), F.col("features").alias("v"))
             .select(every_user_block, item_block, "movieId", "v"))

    # Tiles weigh by their work, not their bytes, so their number fixes the partitions.
    partitions = min(user_blocks * item_blocks, TASKS_PER_CORE * parallelism)
    left = users.unionByName(history).repartition(partitions, "ub", "ib").groupBy("ub", "ib")
    right = items.repartition(partitions, "ub", "ib").groupBy("ub", "ib")
    best = left.cogroup(right).applyInArrow(lambda users, items: tiles.best_in_tile(users, items, n),
                                            "userId int, movieId int, prediction float")
    return rank_per_user(best, n).select("userId", "rank", "movieId", "prediction")


def history_buckets(seen: DataFrame) -> DataFrame:
    """``(userId, n_seen, bucket)``: users by the length of their history, a bucket for each doubling."""
    per_user = seen.filter(F.col("userId").isNotNull() & F.col("movieId").isNotNull()).groupBy("userId").agg(F.count("*").alias("n_seen"))
    return per_user.withColumn("bucket", F.ceil(F.log2("n_seen")).cast("int"))


def overfetched(model: ALSModel, seen: DataFrame, n: int = 25) -> DataFrame:
    """``(userId, movieId, prediction)``: each user's best items, seen ones among them, enough for ``n`` unseen.

    The built-in recommender does not leave out seen items, so it is asked for more than ``n``: for as
    many more as the longest history has. One heavy user would make that too many for everyone, so
    users are bucketed by the length of their history and every bucket asks by its own longest, which is less than
    twice anyone's own. A bucket is a doubling, so there are as many as a history's length has bits, and the rows of all
    are at most ``n`` for each user and twice the seen pairs, written once. Users without a history form a bucket of their own.
    """
    lengths = settle(history_buckets(seen))
    users = model.userFactors.select(F.col("id").alias("userId")).join(lengths, "userId", "left")
    users = settle(users.select("userId", F.coalesce("n_seen", F.lit(0)).alias("n_seen"), F.coalesce("bucket", F.lit(-1)).alias("bucket")))
    longest = users.groupBy("bucket").agg(F.max("n_seen").alias("longest")).collect()  # a row for each doubling
    parts = None
    for row in sorted(longest):
        asked = users.filter(F.col("bucket") == row["bucket"]).select("userId")
        found = (model.recommendForUserSubset(asked, n + row["longest"]).select("userId", F.explode("recommendations").alias("r"))
                 .select("userId", "r.movieId", F.col("r.rating").alias("prediction")))
        parts = found if parts is None else parts.unionByName(found)
    if parts is None:
        return model.userFactors.limit(0).select(F.col("id").alias("userId"), F.col("id").alias("movieId"), F.lit(0.0).cast("float").alias("prediction"))
    return settle(parts)


def top_n_by_overfetch(model: ALSModel, seen: DataFrame, n: int = 25) -> DataFrame:
    """The lists of ``top_n_per_user`` from the built-in recommender: fetch enough, drop the seen, rank again.

    For all items only; a filter on the items could leave too few of those fetched.
    """
    unseen = overfetched(model, seen, n).join(seen.select("userId", "movieId"), ["userId", "movieId"], "left_anti")
    return rank_per_user(unseen.filter(is_scored()), n).select("userId", "rank", "movieId", "prediction")
