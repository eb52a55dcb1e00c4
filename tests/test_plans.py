"""The physical plans at scale: what is pushed down, and what must not appear."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from palate.operators import als, candidates, evaluate, profile, ranking
from palate.sources import schemas, tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, ratings, items, tmp_path):
    ratings.write.parquet(str(tmp_path / "ratings"))
    items.write.parquet(str(tmp_path / "items"))
    return (spark.read.schema(schemas.RATINGS).parquet(str(tmp_path / "ratings")),
            spark.read.schema(schemas.ITEMS).parquet(str(tmp_path / "items")))


@pytest.fixture
def without_broadcast(spark):
    """Plans as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def model(ratings):
    return als.fit(ratings, rank=2, max_iter=1)


@pytest.mark.parametrize("name", sorted(entry_point.queries()))
def test_no_query_pairs_everything_with_everything(spark, folder, without_broadcast, name, model, monkeypatch):
    monkeypatch.setattr(als, "fit", lambda *args, **options: model)
    search = als.grid_search  # of one candidate, and in no ledger that other tests read
    monkeypatch.setattr(als, "grid_search", lambda train, held, **options: search(train, held, (2,), (0.1,), keep_models=True))
    text = plan(entry_point.queries()[name](spark, folder))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text


def test_user_filter_and_columns_reach_the_scan(stored):
    text = plan(candidates.watched(*stored, 42))
    assert "EqualTo(userId,42)" in text
    assert "timestamp" not in text


def test_summary_reads_either_table_once_and_ids_only(spark, stored, folder, tmp_path):
    """Bitmaps move, not ids: one scan of the ratings, and nothing but blocks behind its one exchange by block."""
    text = plan(profile.dataset_summary(*stored))
    assert sorted(re.findall(r"ReadSchema: (\S+)", text)) == ["struct<>", "struct<userId:int,movieId:int>"]
    (tmp_path / "copy").symlink_to(folder)  # a path of its own, which no other test has cached
    folder = str(tmp_path / "copy")
    view = plan(profile.dataset_summary(tables.ratings(spark, folder), tables.items(spark, folder)))
    assert view.count("FileScan parquet [l_") == 1


def test_genre_pattern_becomes_a_pushed_contains(stored):
    assert "StringContains(genres,ECONOMY)" in plan(stored[1].filter(candidates.genre_like("ECONOMY")))


def test_top_n_is_one_bounded_sort(stored):
    assert "TakeOrderedAndProject" in plan(candidates.watched_top(candidates.watched(*stored, 42)))


def test_per_user_rank_cuts_before_the_shuffle(spark, folder):
    factors = tables.factors(spark, folder)
    pairs = tables.ratings(spark, folder).select("userId", "movieId")
    text = plan(ranking.rank_per_user(ranking.score_pairs(pairs, factors, factors), 5))
    assert text.count("WindowGroupLimit") == 2


def test_counts_are_combined_before_the_shuffle(stored):
    assert "partial_count" in plan(profile.item_rating_counts(stored[0]))


# Hot keys: one key holds a third of the rows, and tables are too large to broadcast.

@pytest.fixture
def small_pieces(spark, without_broadcast):
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


@pytest.fixture(scope="module")
def skewed(spark):
    """Item 7 and user 7 hold a third of the ratings each."""
    n = F.col("id")
    return spark.range(450000, numPartitions=8).select(
        F.when(n % 3 == 0, 7).otherwise(n % 9973 + 100).cast("int").alias("userId"),
        F.when(n % 3 == 1, 7).otherwise(n % 7919 + 100).cast("int").alias("movieId"),
        (F.rand(1) * 5).cast("float").alias("rating"), n.cast("string").alias("timestamp"))


def executed(df):
    """Rows and final plan; only a join that was really cut up at run time says ``skew=true``."""
    rows = df.collect()
    return rows, plan(df)


def test_hot_item_is_split_in_the_evaluation_join(small_pieces, skewed):
    rows, text = executed(evaluate.rmse(evaluate.predict_item_mean(skewed, skewed)))
    assert "skew=true" in text and rows[0].n_scored == 450000


def test_hot_item_is_split_when_counting_pools(small_pieces, spark, skewed):
    distinct = skewed.withColumn("userId", F.col("timestamp").cast("int"))
    items = distinct.select("movieId").distinct()
    _, text = executed(candidates.unwatched_counts(distinct, items).agg(F.sum("n_unwatched")))
    assert "skew=true" in text


def test_hot_user_and_item_are_split_while_scoring(small_pieces, spark, skewed, tmp_path):
    ids = spark.range(20000).select(F.col("id").cast("int"), F.array(F.lit(1.0).cast("float")).alias("features"))
    ids.write.parquet(str(tmp_path / "factors"))
    factors = spark.read.parquet(str(tmp_path / "factors"))
    scored = ranking.score_pairs(skewed, factors, factors)
    rows, text = executed(evaluate.rmse(scored))
    assert text.count("skew=true") == 2 and rows[0].n_scored == 450000


def test_hot_user_and_item_are_split_in_the_audit(small_pieces, skewed):
    scored = skewed.withColumn("prediction", F.rand(2).cast("float"))
    rows, text = executed(evaluate.cold_start_audit(scored, skewed))
    assert text.count("skew=true") == 2
    assert [(r.warm_user, r.warm_item, r.n_rows) for r in rows] == [(True, True, 450000)]


def test_hot_order_is_split_in_the_ratings_view(small_pieces, spark, tmp_path):
    n = F.col("id")
    spark.range(300000, numPartitions=8).select(
        F.when(n % 3 == 0, 5).otherwise(n).alias("l_orderkey"), n.alias("l_partkey"),
        (n % 50 + 1).cast("double").alias("l_quantity"),
        F.lit("1995-01-01").cast("timestamp_ntz").alias("l_shipdate")
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(300000, numPartitions=8).select(n.alias("o_orderkey"), (n % 1000).alias("o_custkey")).write.parquet(
        str(tmp_path / "orders.parquet"))
    rows, text = executed(tables.ratings(spark, str(tmp_path)).agg(F.count("*").alias("n")))
    assert "skew=true" in text and rows[0].n == 300000


def test_lists_are_whole_under_skew(spark, skewed):
    """The hot user has rated most items; every list is still complete and free of seen items."""
    ids = spark.range(100, 1100).select(F.col("id").cast("int"),
                                        F.array(F.sin("id").cast("float"), F.cos("id").cast("float")).alias("features"))
    users = spark.createDataFrame([(7, [1.0, 0.5]), (101, [0.2, 0.9])], "id int, features array<float>")
    lists = ranking.top_n_per_user(users, ids, skewed, 5, tile_items=100)
    seen = skewed.select("userId", "movieId").distinct()
    free = {u: 1000 - seen.filter(f"userId = {u} AND movieId BETWEEN 100 AND 1099").count() for u in (7, 101)}
    counts = {r.userId: r["count"] for r in lists.groupBy("userId").count().collect()}
    assert counts == {u: min(5, k) for u, k in free.items() if k}
    assert lists.join(seen, ["userId", "movieId"]).count() == 0


def test_registered_one_user_queries_filter_the_raw_key_in_the_scan(spark, folder):
    for name in ("user_watched", "user_unwatched"):
        assert "EqualTo(o_custkey,42)" in plan(entry_point.queries()[name](spark, folder))
