"""Fixed input schemas; nothing is inferred."""

from pyspark.sql.types import FloatType, IntegerType, StringType, StructField, StructType

# Column names and types of the input files.
RATINGS = StructType([
    StructField("userId", IntegerType()),
    StructField("movieId", IntegerType()),
    StructField("rating", FloatType()),
    StructField("timestamp", StringType()),
])

ITEMS = StructType([
    StructField("movieId", IntegerType()),
    StructField("title", StringType()),
    StructField("genres", StringType()),
])
