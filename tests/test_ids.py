import pytest

from palate.operators import ids


def test_index_follows_id_order_without_gaps(spark):
    wide = [(2**40 + 7 * k % 1009,) for k in range(3000)] + [(None,), (-5,)]
    index = ids.dense_index(spark.createDataFrame(wide, "k long"), "k").orderBy("k").collect()
    distinct = sorted({k for k, in wide if k is not None})
    assert [(r.k, r["index"]) for r in index] == [(k, n) for n, k in enumerate(distinct)]


def test_replacing_a_wide_column(spark):
    df = spark.createDataFrame([(10**12, "a"), (5, "b"), (10**12, "c"), (None, "d")], "k long, v string")
    out = ids.with_index(df, ids.dense_index(df, "k"), "k")
    assert out.columns == df.columns
    assert sorted(tuple(r) for r in out.collect()) == [(0, "b"), (1, "a"), (1, "c")]


def test_nothing_in_nothing_out(spark):
    assert ids.dense_index(spark.createDataFrame([], "k long"), "k").count() == 0
