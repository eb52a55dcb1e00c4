import pytest

from palate.operators import als, candidates
from palate.plans import study
from palate.sources import models


@pytest.fixture(scope="module")
def csv_files_on_disk(tmp_path_factory, ratings, items):
    base = tmp_path_factory.mktemp("study")
    ratings.write.option("header", True).csv(str(base / "ratings.csv"))
    items.write.option("header", True).csv(str(base / "items.csv"))
    return base


def test_the_whole_study_runs_from_csv(spark, csv_files_on_disk, capsys, ratings):
    base = csv_files_on_disk
    study.main(["--ratings", str(base / "ratings.csv"), "--items", str(base / "items.csv"),
                "--full-ratings", str(base / "ratings.csv"), "--model", str(base / "model"),
                "--work", str(base / "work"), "--user", "42", "--floor", "30", "--genres", "ECONOMY",
                "--ranks", "2", "--reg-params", "0.1", "--all-users", str(base / "lists")])
    printed = capsys.readouterr().out
    for section in ("small summary", "search", "test error", "final error", "popular_top_ECONOMY"):
        assert section in printed
    assert models.load_model(str(base / "model")).rank == 2
    lists = spark.read.parquet(str(base / "lists"))
    assert lists.select("userId").distinct().count() == ratings.select("userId").distinct().count()


def test_lists_obey_their_rules(ratings, items):
    model = als.fit(ratings, rank=2, max_iter=2)
    lists = study.recommendations(model, ratings, items, 42, n=10, floor=30, genres=("ECONOMY",))
    seen = {r.movieId for r in ratings.filter("userId = 42").collect()}
    counts = {r.movieId: r["count"] for r in ratings.groupBy("movieId").count().collect()}
    for name in ("top", "top_ECONOMY", "popular_top", "popular_top_ECONOMY"):
        rows = lists[name].collect()
        assert rows and not seen & {r.movieId for r in rows}
        if name.startswith("popular"):
            assert all(counts[r.movieId] >= 30 for r in rows)
        if name.endswith("ECONOMY"):
            assert all("ECONOMY" in r.genres for r in rows)
    pool = candidates.unwatched(ratings, items, 42).count()
    assert pool == items.count() - len(seen)
