"""The whole analysis over CSV files: profile, tune, train, recommend, save.

    spark-submit --py-files palate.zip palate/plans/study.py \\
        --ratings small/ratings.csv --items full/movies.csv --full-ratings full/ratings.csv \\
        --model models/als --work work/ --user 1000
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from palate.operators import als, candidates, evaluate, profile, ranking, split
from palate.session import clear_scratch, materialize
from palate.sources import csv_files, models, schemas
from palate.sources.paths import checked

# Fixed values of the published analysis.
FLOOR = 50
TOP = 25
GENRES = ("Comedy", "Sci-Fi", "Animation")


def profiles(ratings: DataFrame, items: DataFrame) -> dict[str, DataFrame]:
    counts = profile.item_rating_counts(ratings)
    return {
        "summary": profile.dataset_summary(ratings, items),
        "stats": profile.rating_stats(ratings),
        "histogram": profile.rating_histogram(ratings),
        "ratings_per_item": profile.avg_ratings_per_item(counts),
    }


def tune(ratings: DataFrame, ranks: Sequence[int] = als.RANKS, reg_params: Sequence[float] = als.REG_PARAMS,
         parallelism: int = 1, ledger: str | None = None, **options) -> tuple[als.Search, DataFrame, DataFrame]:
    """Search on a 60/20/20 random split; returns the search, its test error and the test rows.

    With a ``ledger`` a search that was lost goes on where it stopped, as long as the split falls out alike.
    """
    train, validation, test = split.random_split(ratings)
    search = als.grid_search(train, validation, ranks, reg_params, parallelism, ledger, **options)
    return search, evaluate.rmse(search.model.transform(test)), test


def recommendations(model, ratings: DataFrame, items: DataFrame, user_id: int, n: int = TOP,
                    floor: int = FLOOR, genres: Sequence[str] = GENRES) -> dict[str, DataFrame]:
    """One user's lists: over everything unseen, and over unseen items with ``floor`` ratings or more."""
    watched = candidates.watched(ratings, items, user_id)
    pool = candidates.unwatched(ratings, items, user_id)
    low = profile.low_count_items(profile.item_rating_counts(ratings), floor)
    # The pool is scored once, with a mark on the items under the floor, and every list reads that.
    marked = pool.join(low.select("movieId", F.lit(True).alias("low")), "movieId", "left").fillna(False, ["low"])
    everything = materialize(ranking.score_pool(model, marked, user_id))
    scored = {"": everything.drop("low"), "popular_": everything.filter(~F.col("low")).drop("low")}
    lists = {"watched": candidates.watched_top(watched), "unwatched": profile.head(pool, 20, "movieId"),
             "under_floor": low.agg(F.count("*").alias("n_items"))}
    for prefix, rows in scored.items():
        lists[f"{prefix}top"] = ranking.top_n(rows, n)
        for genre in genres:
            lists[f"{prefix}top_{genre}"] = ranking.top_n(rows, n, candidates.genre_like(genre))
    return lists


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--ratings", required=True, help="ratings CSV used for tuning")
    parser.add_argument("--items", required=True, help="items CSV")
    parser.add_argument("--full-ratings", help="ratings CSV for the final model (default: --ratings)")
    parser.add_argument("--model", required=True, help="where the final model is saved")
    parser.add_argument("--work", required=True, help="shared folder for the Parquet copies of the CSV files and for all results")
    parser.add_argument("--user", type=int, required=True)
    parser.add_argument("--floor", type=int, default=FLOOR)
    parser.add_argument("--genres", nargs="*", default=list(GENRES))
    parser.add_argument("--ranks", nargs="*", type=int, default=list(als.RANKS))
    parser.add_argument("--reg-params", nargs="*", type=float, default=list(als.REG_PARAMS))
    parser.add_argument("--all-users", help="also write every user's list here, as Parquet")
    parser.add_argument("--parallelism", type=int, default=1, help="candidates fitted at a time")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.getOrCreate()
    for path in (args.model, args.work, args.all_users):
        checked(path or "")

    def converted(source: str, schema, name: str) -> DataFrame:
        done = csv_files.convert_audited(spark, source, schema, f"{args.work}/{name}", f"{args.work}/{name}-rejected")
        print(f"{name}: {done.counts}")
        return done.rows

    small, items = converted(args.ratings, schemas.RATINGS, "ratings"), converted(args.items, schemas.ITEMS, "items")
    full = converted(args.full_ratings, schemas.RATINGS, "full-ratings") if args.full_ratings else small

    for df, keys in ((small, ("userId", "movieId")), (items, ("movieId",))):
        df.printSchema()
        profile.head(df, 5, *keys).show(truncate=False)
    show = {f"small {k}": v for k, v in profiles(small, items).items()}
    search, test_error, test = tune(small, args.ranks, args.reg_params, args.parallelism, f"{args.work}/search")
    show |= {"search": search.metrics, "test error": test_error}
    if args.full_ratings:
        show |= {f"full {k}": v for k, v in profiles(full, items).items()}

    model = als.fit(full, search.rank, search.reg_param)
    # The final model has seen the test rows whenever both files share ratings.
    show["final error"] = evaluate.rmse(model.transform(test))
    show |= recommendations(model, full, items, args.user, floor=args.floor, genres=args.genres)
    for name, df in show.items():
        path = f"{args.work}/results/{name.replace(' ', '-')}"
        df.write.mode("overwrite").parquet(path)
        print(f"{name} (first rows; all are in {path})")
        spark.read.parquet(path).show(100, truncate=False)
    models.save_model(model, args.model)
    if args.all_users:
        lists = ranking.top_n_per_user(model.userFactors, model.itemFactors, full)
        lists.write.mode("overwrite").parquet(args.all_users)
    clear_scratch(spark)


if __name__ == "__main__":
    main()
