"""Time the headline queries and print one JSON line.

Every query is timed to the end of an action that consumes all its rows, once
cold (class loading, code generation and Python workers included) and once
warm; nothing is kept between the runs. ``queries`` and ``value`` are the warm
times. The ``stage_*`` entries time the steps of one recommendation session, with
the lists taken cold (scoring included) and warm (scored pool in memory) apart.
"""

import json
import os
import time

from palate.operators import als, candidates, profile, ranking, split
from palate.plans.queries import FLOOR, GENRE, QUERIES, RANK, REG_PARAM, TOP, USER
from palate.session import clear_scratch, local_session, scratch_path
from palate.sources import models, tables

HEADLINE = [
    "ratings_scan", "dataset_summary", "rating_stats", "rating_histogram", "item_rating_counts",
    "low_count_items", "user_watched_top20", "user_unwatched", "all_users_unwatched_counts",
    "popular_unwatched", "genre_filter", "hash_split_counts", "item_mean_rmse", "grid_argmin",
    "factor_scores", "topn_per_user", "csv_ratings_scan", "csv_convert_audit", "als_test_rmse",
    "als_topn_user_popular_genre", "als_topn_all_users", "als_save_load_roundtrip",
    "topn_one_user_popular_genre", "als_fit_residuals", "als_final_rmse", "als_cold_start_audit",
    "als_topn_user_checks",
]
#: The whole search is 42 fits; it is timed once.
COLD_ONLY = ["als_grid_search"]


def consume(df):
    df.write.format("noop").mode("overwrite").save()


def timed(action):
    begin = time.perf_counter()
    result = action()
    return result, round(time.perf_counter() - begin, 3)


def stages(spark, folder):
    """The steps of one session: search, fit, score, list, save, load."""
    seconds = {}
    ratings, items = tables.ratings(spark, folder), tables.items(spark, folder)
    with als.persisted(ratings, items):
        train, validation, _ = split.hash_split(ratings)
        _, seconds["stage_search"] = timed(
            lambda: als.grid_search(train, validation, (2, RANK), (REG_PARAM,), parallelism=2))
        model, seconds["stage_fit"] = timed(lambda: als.fit(ratings, RANK, REG_PARAM))
        low = profile.low_count_items(profile.item_rating_counts(ratings), FLOOR)
        pool = candidates.without_items(candidates.unwatched(ratings, items, USER), low)
        scored = ranking.score_pool(model, pool, USER)
        with als.persisted(scored):
            _, seconds["stage_top_cold"] = timed(lambda: consume(ranking.top_n(scored, TOP)))
            _, seconds["stage_top_genre_warm"] = timed(
                lambda: consume(ranking.top_n(scored, TOP, candidates.genre_like(GENRE))))
        path = scratch_path(spark, "bench-model")
        _, seconds["stage_save"] = timed(lambda: models.save_model(model, path))
        _, seconds["stage_load"] = timed(lambda: models.load_model(path))
    return seconds


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus, {"spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8"})
    time_of = lambda name: timed(lambda: consume(QUERIES[name](spark, folder)))[1]
    cold, warm = ({name: time_of(name) for name in HEADLINE} for _ in range(2))
    warm.update({name: time_of(name) for name in COLD_ONLY})
    warm.update(stages(spark, folder))
    print(json.dumps({"metric": "headline_total", "value": round(sum(warm.values()), 3), "unit": "sec",
                      "queries": warm, "cold": cold, "sf": os.path.basename(folder.rstrip("/"))}))
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
