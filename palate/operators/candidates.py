"""What a user has rated, what is left to recommend, and the filters on that pool."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from palate.operators.joins import lookup


def watched(ratings: DataFrame, items: DataFrame, user_id: int) -> DataFrame:
    """Rated items of one user, with titles. The user filter reaches the ratings scan."""
    return (ratings.filter(F.col("userId") == user_id)
            .join(items, "movieId")
            .select("movieId", "userId", "title", "rating"))


def watched_top(watched_items: DataFrame, n: int = 20) -> DataFrame:
    return watched_items.orderBy(F.desc("rating"), "movieId").limit(n)


def unwatched(ratings: DataFrame, items: DataFrame, user_id: int) -> DataFrame:
    """Items the user has not rated: the candidate pool of that user."""
    seen = ratings.filter(F.col("userId") == user_id).select("movieId")
    return items.join(seen, "movieId", "left_anti").withColumn("userId", F.lit(user_id))


def unwatched_counts(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """Size of every user's candidate pool, without forming a single user-item pair."""
    known = items.select("movieId").distinct().withColumn("known", F.lit(1))
    seen = lookup(ratings.select("userId", "movieId").distinct(), known, "movieId")
    n_items = known.agg(F.count("*").alias("n")).scalar()
    return (seen.groupBy("userId").agg(F.count("known").alias("n_seen"))
            .select("userId", (n_items - F.col("n_seen")).alias("n_unwatched")))


def without_items(pool: DataFrame, excluded: DataFrame) -> DataFrame:
    """Drop items listed in ``excluded`` (for instance those under a popularity floor)."""
    return pool.join(excluded.select("movieId"), "movieId", "left_anti")


def genre_like(text: str, column: str = "genres") -> Column:
    """Case-sensitive substring match, so ``Brand#1`` also finds ``Brand#12``."""
    return F.col(column).like(f"%{text}%")


def genre_is(token: str, column: str = "genres") -> Column:
    """Match one whole entry of the ``|``-separated list."""
    return F.array_contains(F.split(column, r"\|"), token)


def orphan_ratings(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """One row: ratings whose item is missing from the items table, which ``watched`` leaves out."""
    per_item = ratings.groupBy("movieId").agg(F.count("*").alias("n"))
    lost = per_item.join(items.select("movieId"), "movieId", "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_orphans"))
