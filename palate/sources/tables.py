"""Ratings, items and fixed factors seen through the driver's Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from palate.functions.narrow import as_int

SECONDS_PER_DAY = 86400


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ratings(spark: SparkSession, folder: str, user_id: int | None = None) -> DataFrame:
    """One rating per (buyer, part): the largest quantity, 1-50, as half stars 0.5-5.0.

    Ids must fit 32 bits and are refused otherwise; see ``operators.ids``. With
    ``user_id`` only that user's ratings, filtered on the raw key: a filter on the
    narrowed one would not reach the Parquet scan.
    """
    lines = table(spark, folder, "lineitem").filter(F.col("l_partkey").isNotNull())
    orders = table(spark, folder, "orders").filter(F.col("o_custkey").isNotNull())
    if user_id is not None:
        orders = orders.filter(F.col("o_custkey") == user_id)
    per_pair = (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
                .groupBy("o_custkey", "l_partkey")
                .agg(F.max("l_quantity").alias("quantity"), F.max("l_shipdate").alias("day")))
    days = F.datediff(F.col("day").cast("date"), F.lit("1970-01-01").cast("date"))
    return per_pair.select(
        as_int(F.col("o_custkey"), "o_custkey").alias("userId"),
        as_int(F.col("l_partkey"), "l_partkey").alias("movieId"),
        (F.ceil(F.col("quantity") / 5) * F.lit(0.5)).cast("float").alias("rating"),
        (days.cast("long") * SECONDS_PER_DAY).cast("string").alias("timestamp"))


def items(spark: SparkSession, folder: str) -> DataFrame:
    return (table(spark, folder, "part").filter(F.col("p_partkey").isNotNull())
            .select(as_int(F.col("p_partkey"), "p_partkey").alias("movieId"),
                    F.col("p_name").alias("title"),
                    F.concat("p_type", F.lit("|"), "p_brand").alias("genres")))


def factors(spark: SparkSession, folder: str) -> DataFrame:
    """The embeddings in the shape of a model's factor table."""
    return (table(spark, folder, "embeddings")
            .select(as_int(F.col("vec_id"), "vec_id").alias("id"), F.col("embedding").alias("features")))
