"""Dense 32-bit indexes for wide ids, which the factorisation solver cannot take."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from palate.functions.narrow import as_int
from palate.session import materialize

POSITION_BITS = 33  # low bits of monotonically_increasing_id: the row's place in its partition


def dense_index(df: DataFrame, column: str) -> DataFrame:
    """``(column, index)`` with the distinct ids numbered 0, 1, 2, ... in id order.

    The distinct ids are range-partitioned, sorted and written once. A row's
    index is then its place in its partition plus the sizes of the partitions
    before it; the running total covers one row per partition, never the ids.
    More than 2**31 distinct ids are refused instead of wrapping round.
    """
    ids = df.select(column).filter(F.col(column).isNotNull()).distinct()
    ordered = materialize(ids.repartitionByRange(column).sortWithinPartitions(column))
    place = F.monotonically_increasing_id()
    located = ordered.select(column, F.shiftright(place, POSITION_BITS).alias("part"),
                             place.bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).alias("place"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (located.groupBy("part").agg(F.count("*").alias("n"))
              .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    return (located.join(F.broadcast(starts), "part")
            .select(column, as_int(F.col("start") + F.col("place"), "index").alias("index")))


def with_index(df: DataFrame, index: DataFrame, column: str) -> DataFrame:
    """Replace ``column`` by its dense index; ids without one are left out."""
    others = [c for c in df.columns if c != column]
    joined = df.join(index, column)
    return joined.select(*others, F.col("index").alias(column)).select(*df.columns)
