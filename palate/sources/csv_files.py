"""Typed CSV input: header skipped, malformed rows left out, and told apart and counted on request."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from palate.session import scratch_path
from palate.sources.paths import checked

CORRUPT = "_corrupt_record"
REASON = "_reason"
MALFORMED, NULL_ID = "malformed", "null id"
IDS = ("userId", "movieId")


def _reader(spark: SparkSession, schema: StructType, mode: str, source_format: str = "csv"):
    # Doubled quotes inside a quoted field are the CSV norm, so " escapes itself.
    return (spark.read.format(source_format).schema(schema)
            .option("header", True).option("mode", mode).option("escape", '"'))


def _every_column_read(columns: list[str]) -> Column:
    """Always true, but keeps every column in the scan's ReadSchema.

    The CSV parser only notices a bad value in a column it converts, so with
    column pruning the rows that count as malformed would depend on which
    columns a later step happens to use.
    """
    return F.pmod(F.hash(*columns), F.lit(2)) >= 0


def load_csv(spark: SparkSession, path: str, schema: StructType, ids: tuple[str, ...] = IDS,
             source_format: str = "csv") -> DataFrame:
    """Well-formed rows of ``path``; rows with a null id are left out.

    Pass ``ids=()`` to keep null ids. Any Hadoop file system URI is accepted. ``source_format`` names the data
    source, by its short name or by its class.
    """
    rows = _reader(spark, schema, "DROPMALFORMED", source_format).load(checked(path))
    rows = rows.filter(_every_column_read(rows.columns))
    for key in ids:
        if key in rows.columns:
            rows = rows.filter(F.col(key).isNotNull())
    return rows


def judged_csv(spark: SparkSession, path: str, schema: StructType, ids: tuple[str, ...] = IDS) -> DataFrame:
    """All lines of ``path``: the typed columns, ``CORRUPT`` (the text of a malformed line) and ``REASON``.

    The reason is null for a row that ``load_csv`` keeps.
    """
    wide = StructType([*schema.fields]).add(CORRUPT, StringType())
    rows = _reader(spark, wide, "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).load(checked(path))
    rows = rows.filter(_every_column_read(rows.columns))
    no_id = F.lit(False)
    for key in ids:
        if key in schema.fieldNames():
            no_id = no_id | F.col(key).isNull()
    return rows.withColumn(REASON, F.when(F.col(CORRUPT).isNotNull(), MALFORMED).when(no_id, NULL_ID))


def _counts() -> list[Column]:
    return [F.count(F.lit(1)).alias("n_lines"), F.count_if(F.col(REASON).eqNullSafe(MALFORMED)).alias("n_malformed"),
            F.count_if(F.col(REASON).eqNullSafe(NULL_ID)).alias("n_null_id"), F.count_if(F.col(REASON).isNull()).alias("n_kept")]


def audit_csv(spark: SparkSession, path: str, schema: StructType, id_col: str) -> DataFrame:
    """One row: how many lines a load keeps, drops as malformed and drops for a null id."""
    return judged_csv(spark, path, schema, (id_col,)).agg(*_counts())


@dataclass(frozen=True)
class Conversion:
    """The Parquet rows, the lines left out with their reasons, and how many there were of each."""

    rows: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def convert_audited(spark: SparkSession, source: str, schema: StructType, target: str, rejects: str,
                    ids: tuple[str, ...] = IDS) -> Conversion:
    """``source`` as Parquet under ``target``, what was left out under ``rejects``, and the counts, in one read.

    The lines are parsed by one job without a shuffle, which writes them with their reasons and is
    observed as it does so: each task counts once, whatever is retried. Rows to be
    kept are then range-partitioned on all id columns together from that copy, because finding the ranges
    takes a look at the rows of its own: one user's rows sit in adjacent files with tight min/max
    statistics, and a user or item that holds a large share of the rows is still cut into several files.
    """
    target, rejects = checked(target), checked(rejects)
    seen, staged = Observation(), scratch_path(spark, "csv-rows")
    judged_csv(spark, source, schema, ids).observe(seen, *_counts()).write.parquet(staged)
    rows = spark.read.schema(StructType([*schema.fields]).add(CORRUPT, StringType()).add(REASON, StringType())).parquet(staged)
    keys = [c for c in schema.fieldNames() if c in IDS]
    kept = rows.filter(F.col(REASON).isNull()).select(*schema.fieldNames())
    (kept.repartitionByRange(*keys).sortWithinPartitions(*keys) if keys else kept).write.mode("overwrite").parquet(target)
    rows.filter(F.col(REASON).isNotNull()).write.mode("overwrite").parquet(rejects)
    return Conversion(spark.read.schema(schema).parquet(target), spark.read.schema(rows.schema).parquet(rejects), dict(seen.get))


def convert_csv(spark: SparkSession, source: str, schema: StructType, target: str) -> DataFrame:
    """Write the rows as Parquet once, so later scans prune columns and skip row groups."""
    return convert_audited(spark, source, schema, target, scratch_path(spark, "csv-rejects")).rows
