"""From raw documents to token shards: five stages, each writing Parquet that the next reads.

A stage reads ``doc_id``, ``text`` and ``source``; all other columns are carried along as they are, also
those named like a result of its operator. Null texts count as empty, null ids are ids of their own rank,
repeated rows are judged alike, an empty table stays empty. What a stage does with ties its docstring says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from palate.llm.common import fresh, quoted, table
from palate.llm.decontamination import mark
from palate.llm.mixing import mix_by_quality
from palate.llm.near_dups import one_of_each
from palate.llm.quality_rules import BASE, PROSE, accepted, ledger
from palate.llm.token_files import tokenise
from palate.session import scratch_path


class Apart:
    """A table under column names that no operator uses, and the way back to its own."""

    def __init__(self, docs: DataFrame):
        self.columns = docs.columns
        self.names = {c: fresh(f"c{i}") for i, c in enumerate(docs.columns)}
        self.docs = docs.toDF(*self.names.values())

    def back(self, result: DataFrame) -> DataFrame:
        return result.select(*(F.col(self.names[c]).alias(c) for c in self.columns))


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the prose policy accepts; each is judged by itself, an empty one is rejected."""
    own = Apart(docs)
    return own.back(ledger(own.docs, own.names["text"]).filter(accepted(BASE) & accepted(PROSE)))


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each class of near copies, the one with the smallest id, of equal ids one row.

    Documents without words are no copies of each other and stay.
    """
    own = Apart(docs)
    return own.back(one_of_each(own.docs, own.names["doc_id"], own.names["text"]))


def decontaminate(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without any passage of the benchmark; each is judged by itself, an empty one stays."""
    own = Apart(docs)
    marked = mark(own.docs, table(spark, folder, "benchmark"), own.names["text"])
    return own.back(marked.filter(~F.col("contaminated")))


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The mix: every document as many times as it is taken, which may be none.

    Documents without words are never taken. Equal draws go by size, then by a hash of the row.
    """
    own, turn = Apart(docs), fresh("turn")
    names = {"doc_id": own.names["doc_id"], "source": own.names["source"], "text": own.names["text"]}
    mixed = mix_by_quality(own.docs, table(spark, folder, "labels"), **names).filter("copies > 0")
    return own.back(mixed.withColumn(turn, F.explode(F.sequence(F.lit(1), F.col("copies")))))


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """What the token shards hold of each document, in the order of ids; an empty text has its end id only."""
    return tokenise(docs.select(quoted("doc_id"), quoted("text")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality), ("near duplicates", near_duplicates), ("decontamination", decontaminate),
    ("mixing", mix), ("token files", tokens),
]

#: SQL cannot tokenise or sketch, so ``tests/llm`` compares with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage-{place}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
