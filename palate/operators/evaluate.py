"""Prediction error, cold-start accounting, and choosing the best of several candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from palate.functions.vectors import dot
from palate.operators.joins import lookup
from palate.session import materialize


def is_scored(column: str = "prediction") -> Column:
    """A prediction that exists. NaN marks a cold row and sorts above every number."""
    return F.col(column).isNotNull() & ~F.isnan(column)


def drop_cold(predictions: DataFrame) -> DataFrame:
    """Remove unscored rows only; a null in another column is no reason to lose a row."""
    return predictions.filter(is_scored())


def rmse(predictions: DataFrame, label: str = "rating", prediction: str = "prediction") -> DataFrame:
    """One row ``(n_scored, rmse)`` over the scored rows; a single partial + final aggregate.

    NaN becomes null, which the aggregates skip, so no filter makes Spark
    evaluate the prediction a second time.
    """
    guess = F.nanvl(F.col(prediction).cast("double"), F.lit(None).cast("double"))
    gap = F.col(label).cast("double") - guess
    return predictions.agg(F.count(gap).alias("n_scored"), F.sqrt(F.avg(gap * gap)).alias("rmse"))


def cold_start_audit(predictions: DataFrame, train: DataFrame) -> DataFrame:
    """Scored and unscored rows by whether the user and the item occur in ``train``."""
    users = train.select("userId").distinct().withColumn("warm_user", F.lit(True))
    items = train.select("movieId").distinct().withColumn("warm_item", F.lit(True))
    return (lookup(lookup(predictions, users, "userId"), items, "movieId")
            .groupBy(F.coalesce("warm_user", F.lit(False)).alias("warm_user"),
                     F.coalesce("warm_item", F.lit(False)).alias("warm_item"))
            .agg(F.count("*").alias("n_rows"),
                 F.count_if(F.isnan("prediction")).alias("n_nan"),
                 F.count_if(F.col("prediction").isNull()).alias("n_null")))


def predict_item_mean(train: DataFrame, rows: DataFrame) -> DataFrame:
    """Predict every row by its item's training mean; items unseen in training stay NaN."""
    means = train.groupBy("movieId").agg(F.avg(F.col("rating").cast("double")).alias("prediction"))
    return lookup(rows, means, "movieId").fillna(float("nan"), subset=["prediction"])


def item_moments(ratings: DataFrame, in_train: Column, held_out: Column) -> DataFrame:
    """``(movieId, n, s, m, mean, var)`` of the items that occur in training, in one aggregate.

    ``n`` and ``s`` are an item's training count and sum; ``m``, ``mean`` and ``var`` the count, mean and
    population variance of its held-out ratings. All of them merge, so partial results are combined
    map-side and an item with a third of all ratings moves as a row for each task.
    """
    value = F.col("rating").cast("double")
    rows = ratings.select("movieId", F.when(in_train, value).alias("t"), F.when(held_out, value).alias("h"))
    moments = rows.groupBy("movieId").agg(F.count("t").alias("n"), F.sum("t").alias("s"), F.count("h").alias("m"),
                                          F.avg("h").alias("mean"), F.var_pop("h").alias("var"))
    return moments.filter(F.col("n") > 0)


def _moment_errors(moments: DataFrame, guesses: list[Column]) -> DataFrame:
    """One row ``(n, errors)``: the held-out rows of known items, and their RMSE under each guess for an item.

    Around its own mean an item's squared gaps sum to ``m * var``, around a guess to that and
    ``m * (mean - guess)**2``. Both are sums of squares, so nothing cancels. A null item is scored by nobody.
    """
    m = F.when(F.col("movieId").isNotNull(), F.col("m")).otherwise(0)
    total = F.sum(m)
    error = lambda g: F.sqrt(F.try_divide(F.sum(F.when(m > 0, m * ((F.col("mean") - g) * (F.col("mean") - g) + F.col("var")))), total))
    return moments.agg(F.coalesce(total, F.lit(0)).alias("n"), F.array(*map(error, guesses)).alias("errors"))


def item_mean_rmse(ratings: DataFrame, in_train: Column, held_out: Column) -> DataFrame:
    """``(n_scored, rmse)`` of predicting held-out rows by their item's training mean, in one pass over the rows.

    Equal to ``rmse(predict_item_mean(train, held_out))``, without bringing means and rows together.
    """
    errors = _moment_errors(item_moments(ratings, in_train, held_out), [F.col("s") / F.col("n")])
    return errors.select(F.col("n").alias("n_scored"), F.col("errors")[0].alias("rmse"))


def damped_mean_errors(ratings: DataFrame, in_train: Column, held_out: Column,
                       dampings: list[float]) -> DataFrame:
    """Held-out RMSE of the damped item mean ``(s + k*mu) / (n + k)`` for each damping ``k``.

    ``s`` and ``n`` are an item's training sum and count, ``mu`` the mean over all
    training ratings. The rows are read once, for ``item_moments``, which are written, a row for each item;
    ``mu`` and the whole grid, a column for each damping, are aggregates over those.
    Without a held-out row of a known item the errors are null.
    """
    moments = materialize(item_moments(ratings, in_train, held_out))
    mu = moments.agg(F.sum("s") / F.sum("n")).scalar()
    guesses = [(F.col("s") + k * mu) / (F.col("n") + k) for k in map(float, dampings)]
    damping = F.element_at(F.array(*(F.lit(float(k)) for k in dampings)), F.col("grid_pos") + 1)
    return (_moment_errors(moments, guesses).select(F.posexplode("errors").alias("grid_pos", "rmse"), F.col("n").alias("n_scored"))
            .select("grid_pos", damping.alias("damping"), "n_scored", "rmse"))


def fit_residuals(ratings: DataFrame, user_factors: DataFrame, item_factors: DataFrame, reg_param: float) -> DataFrame:
    """``(userId, residual)``: how far each user's factors are from solving their own equations.

    A fit ends with the users' half step, in which the factors ``u`` of a user with ``n``
    ratings ``r`` solve ``sum((u.v - r) * v) + reg_param * n * u = 0`` over the factors ``v``
    of the rated items. The largest component of the left side is 0 but for rounding.
    A model without users has no equations, so there are no rows.
    """
    users = user_factors.select(F.col("id").alias("userId"), F.col("features").alias("_u"))
    items = item_factors.select(F.col("id").alias("movieId"), F.col("features").alias("_v"))
    rank = user_factors.select(F.size("features").alias("k")).first()
    rows = ratings.select("userId", "movieId", "rating").join(items, "movieId").join(users, "userId")
    gap = dot(F.col("_u"), F.col("_v")) - F.col("rating").cast("double")
    at = lambda c, i: F.col(c)[i].cast("double")
    parts = range(rank["k"] if rank else 0)
    sums = (rows.withColumn("_gap", gap).groupBy("userId")
            .agg(F.count("*").alias("_n"), *(F.sum(F.col("_gap") * at("_v", i) + reg_param * at("_u", i)).alias(f"_{i}") for i in parts)))
    return sums.select("userId", F.greatest(F.lit(0.0), F.lit(0.0), *(F.abs(f"_{i}") for i in parts)).alias("residual"))


def candidate_errors(rows: DataFrame, user_factors: DataFrame, item_factors: DataFrame) -> DataFrame:
    """``(candidate, n_scored, rmse)`` of ``rows`` by factor tables ``(candidate, id, features)`` of many models at once.

    The factors of all candidates are brought together by id, a handful for each id, so the rows meet users and
    items once, whatever the number of candidates; errors are combined map-side.
    """
    side = lambda f, key, name: f.groupBy(F.col("id").alias(key)).agg(
        F.map_from_entries(F.collect_list(F.struct("candidate", "features"))).alias(name))
    known = (rows.select("userId", "movieId", F.col("rating").cast("double").alias("rating"))
             .join(side(user_factors, "userId", "_u"), "userId").join(side(item_factors, "movieId", "_v"), "movieId"))
    both = F.array_intersect(F.map_keys("_u"), F.map_keys("_v"))
    each = known.select("rating", "_u", "_v", F.explode(both).alias("candidate"))
    gap = F.col("rating") - dot(F.col("_u")[F.col("candidate")], F.col("_v")[F.col("candidate")])
    return (each.select("candidate", gap.alias("gap")).groupBy("candidate")
            .agg(F.count("gap").alias("n_scored"), F.sqrt(F.avg(F.col("gap") * F.col("gap"))).alias("rmse")))


def arg_min(metrics: DataFrame) -> DataFrame:
    """The row with the least error; the earliest of equals, and never a NaN."""
    return metrics.filter(is_scored("rmse")).orderBy("rmse", "grid_pos").limit(1)
