import math

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from palate.functions.buckets import split_name
from palate.operators import als, evaluate, split
from palate.sources import tables

NAN = float("nan")
SCORED = "userId int, movieId int, rating float, prediction float"


def test_rmse_skips_unscored_rows(frame):
    rows = frame([(1, 1, 4.0, 3.0), (1, 2, 2.0, 4.0), (2, 1, 5.0, NAN), (2, 2, 1.0, None)], SCORED)
    row = evaluate.rmse(rows).first()
    assert row.n_scored == 2
    assert math.isclose(row.rmse, math.sqrt((1 + 4) / 2))


def test_rmse_of_nothing_is_null(frame):
    row = evaluate.rmse(frame([(1, 1, 4.0, NAN)], SCORED)).first()
    assert (row.n_scored, row.rmse) == (0, None)


def test_rmse_agrees_with_the_ml_evaluator(ratings):
    train, _, test = split.hash_split(ratings)
    predictions = evaluate.drop_cold(evaluate.predict_item_mean(train, test))
    expected = RegressionEvaluator(metricName="rmse", labelCol="rating",
                                   predictionCol="prediction").evaluate(predictions)
    assert math.isclose(evaluate.rmse(predictions).first().rmse, expected, rel_tol=1e-9)


def test_drop_cold_keeps_rows_with_other_nulls(frame):
    rows = frame([(1, None, "x", 3.0), (2, 5, None, NAN)], "movieId int, a int, b string, prediction float")
    assert [r.movieId for r in evaluate.drop_cold(rows).collect()] == [1]


def test_damped_errors_equal_row_by_row_errors(ratings):
    part = split_name()
    grid = evaluate.damped_mean_errors(ratings, part == "train", part == "test", [0.0, 3.0, 50.0])
    rows = [(r.movieId, r.rating, r.part) for r in ratings.withColumn("part", part).collect()]
    sums = {}
    for item, rating, name in rows:
        if name == "train":
            n, s = sums.get(item, (0, 0.0))
            sums[item] = (n + 1, s + rating)
    mu = sum(s for _, s in sums.values()) / sum(n for n, _ in sums.values())
    for row in grid.collect():
        gaps = [(rating - (sums[i][1] + row.damping * mu) / (sums[i][0] + row.damping)) ** 2
                for i, rating, name in rows if name == "test" and i in sums]
        assert row.n_scored == len(gaps)
        assert math.isclose(row.rmse, math.sqrt(sum(gaps) / len(gaps)), rel_tol=1e-9)


def test_errors_from_moments_equal_errors_row_by_row(ratings):
    part = split_name()
    got = evaluate.item_mean_rmse(ratings, part == "train", part == "test").first()
    train, _, test = split.hash_split(ratings)
    want = evaluate.rmse(evaluate.predict_item_mean(train, test)).first()
    assert got.n_scored == want.n_scored and math.isclose(got.rmse, want.rmse, rel_tol=1e-12)


def test_moments_with_nulls_unknown_items_and_a_large_offset(frame):
    """Around 1e6 the squares of the ratings would cancel; the moments do not."""
    far = 1_000_000.0
    rows = frame([(0, 1, far), (0, 1, far + 1), (1, 1, far + 2), (1, 2, 3.0), (0, None, 5.0), (1, None, 6.0), (0, 3, None), (1, 3, 1.0),
                  (1, 1, None)], "userId int, movieId int, rating double")
    grid = evaluate.damped_mean_errors(rows, F.col("userId") == 0, F.col("userId") == 1, [0.0, 1.0]).collect()
    mu = (2 * far + 1 + 5.0) / 3
    assert [r.n_scored for r in grid] == [1, 1]
    assert grid[0].rmse == 1.5
    assert math.isclose(grid[1].rmse, abs(far + 2 - (2 * far + 1 + mu) / 3), rel_tol=1e-12)


def test_the_rows_are_read_once_for_the_whole_grid(spark, folder, monkeypatch, tmp_path):
    """One aggregate over the view, then only its written result."""
    (tmp_path / "copy").symlink_to(folder)  # a path of its own, which no other test has cached
    folder = str(tmp_path / "copy")
    plans, write = [], evaluate.materialize
    monkeypatch.setattr(evaluate, "materialize", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df))
    part = split_name()
    grid = evaluate.damped_mean_errors(tables.ratings(spark, folder), part == "train", part == "validation", [0.0, 1.0, 5.0])
    assert len(plans) == 1 and plans[0].count("FileScan parquet [l_") == 1
    assert "FileScan" not in grid._jdf.queryExecution().executedPlan().toString()
    once = evaluate.item_mean_rmse(tables.ratings(spark, folder), part == "train", part == "test")
    assert once._jdf.queryExecution().executedPlan().toString().count("FileScan parquet [l_") == 1


@pytest.mark.parametrize("errors, winner", [
    ([0.9, 0.7, 0.7], 1), ([NAN, 1.2, NAN], 1), ([None, NAN, 3.0], 2)])
def test_arg_min(frame, errors, winner):
    metrics = frame(list(enumerate(errors)), "grid_pos int, rmse double")
    assert [r.grid_pos for r in evaluate.arg_min(metrics).collect()] == [winner]


def test_arg_min_without_a_finite_error_is_empty(frame):
    assert evaluate.arg_min(frame([(0, NAN)], "grid_pos int, rmse double")).count() == 0


@pytest.mark.parametrize("value", [3.3, 4.1])
def test_constant_ratings_have_no_error_and_a_winner(frame, value):
    rows = frame([(u, i, value) for u in range(30) for i in range(30)])
    part = split_name()
    grid = evaluate.damped_mean_errors(rows, part == "train", part == "validation", [0.0, 1.0, 25.0])
    assert all(r.n_scored > 0 and r.rmse < 1e-9 for r in grid.collect())
    assert evaluate.arg_min(grid).count() == 1


def test_damped_errors_without_held_out_rows_are_null(frame):
    rows = frame([(1, 1, 3.0), (2, 1, 4.0)])
    grid = evaluate.damped_mean_errors(rows, F.lit(True), F.lit(False), [0.0, 5.0])
    assert [(r.grid_pos, r.n_scored, r.rmse) for r in grid.collect()] == [(0, 0, None), (1, 0, None)]


def test_residuals_notice_a_wrong_factor(ratings):
    model = als.fit(ratings, rank=3, reg_param=0.1, max_iter=2)
    worst = lambda users: evaluate.fit_residuals(ratings, users, model.itemFactors, 0.1).agg(F.max("residual")).first()[0]
    assert worst(model.userFactors) < 1e-3
    off = model.userFactors.withColumn("features", F.when(F.col("id") == 42, F.transform("features", lambda x: x + F.lit(0.01)))
                                       .otherwise(F.col("features")))
    assert worst(off) > 1e-3
