import pytest
from pyspark.sql import functions as F

from palate.functions.narrow import as_int


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_wide_ids_are_refused(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = spark.createDataFrame([(-2**31,), (2**31 - 1,), (None,)], "id bigint").select(as_int(F.col("id"), "id").alias("id"))
        assert [r.id for r in rows.collect()] == [-2**31, 2**31 - 1, None] and rows.dtypes == [("id", "int")]
        with pytest.raises(Exception, match="does not fit 32 bits: 2147483648"):
            spark.createDataFrame([(2**31,)], "id bigint").select(as_int(F.col("id"), "id")).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
