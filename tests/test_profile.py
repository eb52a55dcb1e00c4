import math
import statistics

import pytest

from palate.operators import candidates, profile

ROWS = [(1, 10, 4.0), (1, 11, 3.5), (2, 10, 5.0), (3, 12, 0.5), (None, 10, 2.0), (None, 13, 2.0)]


@pytest.fixture
def small_items(spark):
    return spark.createDataFrame(
        [(10, "a", "Comedy|Drama"), (11, "b", "Sci-Fi"), (12, None, "Comedy"), (14, "d", "Drama")],
        "movieId int, title string, genres string")


def test_summary_counts_null_as_one_value(frame, small_items):
    row = profile.dataset_summary(frame(ROWS), small_items).first()
    assert row.asDict() == {"n_ratings": 6, "n_users": 4, "n_rated_items": 4, "n_items": 4}


def test_summary_of_nothing(frame, small_items):
    row = profile.dataset_summary(frame([]), small_items.limit(0)).first()
    assert row.asDict() == {"n_ratings": 0, "n_users": 0, "n_rated_items": 0, "n_items": 0}


def test_distinct_counts_are_exact_for_any_integers(spark):
    """Around block borders, negative, zero, wide, all null, and one value on most rows."""
    edges = [0, 1, -1, 32767, 32768, 32769, -32768, -32769, 65536, 2**31 - 1, -2**31, 2**62, -2**62, None, None, 7]
    rows = [(v, (i % 3) if i % 5 else None, None) for i, v in enumerate(edges)] + [(7, 1, None)] * 200
    df = spark.createDataFrame(rows, "a bigint, b int, c smallint")
    row = profile.distinct_counts(df.repartition(5), "a", "b", "c").first()
    assert row.asDict() == {"n_rows": len(rows), "n_a": len(set(edges)), "n_b": len({r[1] for r in rows}), "n_c": 1}
    assert df.select("a").distinct().count() == row.n_a


def test_stats(frame):
    row = profile.rating_stats(frame(ROWS)).first()
    values = [r[2] for r in ROWS]
    assert row.mean_rating == statistics.mean(values)
    assert (row.min_rating, row.max_rating) == (0.5, 5.0)
    assert math.isclose(row.stddev_rating, statistics.stdev(values))


def test_histogram_is_ordered(frame):
    assert [tuple(r) for r in profile.rating_histogram(frame(ROWS)).collect()] == [
        (0.5, 1), (2.0, 2), (3.5, 1), (4.0, 1), (5.0, 1)]


def test_unrated_items_are_not_in_the_low_count_list(frame, small_items):
    low = profile.low_count_items(profile.item_rating_counts(frame(ROWS)), 3)
    assert {r.movieId for r in low.collect()} == {11, 12, 13}
    pool = candidates.without_items(candidates.unwatched(frame(ROWS), small_items, 2), low)
    # Item 14 has no rating at all: the floor leaves it in, only the model's factors remove it.
    assert {r.movieId for r in pool.collect()} == {14}


def test_watched_leaves_out_items_without_a_title_row(frame, small_items):
    rows = frame([(1, 10, 4.0), (1, 99, 5.0), (2, 11, 1.0)])
    assert [tuple(r) for r in candidates.watched(rows, small_items, 1).collect()] == [(10, 1, "a", 4.0)]
    assert candidates.orphan_ratings(rows, small_items).first().n_orphans == 1


def test_watched_top_breaks_ties_by_item(frame, small_items):
    rows = frame([(1, 12, 4.0), (1, 10, 4.0), (1, 11, 4.5)])
    top = candidates.watched_top(candidates.watched(rows, small_items, 1), 2)
    assert [r.movieId for r in top.collect()] == [11, 10]


def test_unwatched_with_a_null_item_among_the_seen(frame, small_items):
    rows = frame([(1, 10, 4.0), (1, None, 4.0)])
    assert {r.movieId for r in candidates.unwatched(rows, small_items, 1).collect()} == {11, 12, 14}


def test_unwatched_counts_equal_the_pools(frame, small_items):
    rows = frame([(1, 10, 4.0), (1, 11, 4.0), (1, 10, 1.0), (2, 99, 3.0), (3, 14, 2.0)])
    counts = {r.userId: r.n_unwatched for r in candidates.unwatched_counts(rows, small_items).collect()}
    assert counts == {u: candidates.unwatched(rows, small_items, u).count() for u in (1, 2, 3)}


def test_genre_substring_and_token(spark):
    df = spark.createDataFrame([("X|Brand#1",), ("X|Brand#12",), ("x|brand#1",)], "genres string")
    assert df.filter(candidates.genre_like("Brand#1")).count() == 2
    assert df.filter(candidates.genre_is("Brand#1")).count() == 1
