"""Token counts through a cache keyed by content digest and tokenizer version.

A text that was counted before, in this corpus or an earlier one, is never encoded again.
Texts are normalised, digested with SHA-256 in the JVM and joined to the stored
counts; each distinct text without one is encoded once and appended. The cache is
a folder of Parquet files for each tokenizer version, which is a digest of the
vocabulary file, the library and its release, cut by the first byte of the digest: a run reads the
cuts that its own digests fall into, once.

Counts are the library's own for the whole text: no begin, end or special tokens
added, no truncation, however long. Null counts as empty: 0 bytes, 0 tokens. Repeated texts share
an entry; ties do not occur. An empty table gives an empty result, and leaves the cache as it is.
Input columns named like a result column are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from palate.llm.common import fresh, others, quoted, table
from palate.session import exists, materialize, scratch_path

LIMIT = 4096
SCHEMA = "digest binary, n_tokens bigint"
#: Bytes of missing digests that may be sent to the executors to pick out their texts.
MAX_SENT = 64 << 20
_COUNTERS: dict[str, Callable[[list[str]], list[int]]] = {}


def counter(path: str) -> Callable[[list[str]], list[int]]:
    """The library's counts for a list of texts; loaded once in a Python process."""
    if path not in _COUNTERS:
        if path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _COUNTERS[path] = lambda texts: [len(model.encode(t, num_threads=1)) for t in texts]
        else:
            from tokenizers import Tokenizer
            vocabulary = Tokenizer.from_file(path)
            vocabulary.no_truncation()
            vocabulary.no_padding()
            _COUNTERS[path] = lambda texts: [len(vocabulary.encode(t, add_special_tokens=False).ids) for t in texts]
    return _COUNTERS[path]


def tokenizer_version(path: str) -> str:
    """A digest that changes with the vocabulary file or the library's release."""
    import sentencepiece
    import tokenizers

    library = sentencepiece if path.endswith(".model") else tokenizers
    with open(path, "rb") as file:
        return hashlib.sha256(f"{library.__name__} {library.__version__}\n".encode() + file.read()).hexdigest()


def as_is(text: Column) -> Column:
    """The only change that no tokenizer can notice: null reads as empty."""
    return F.coalesce(text, F.lit(""))


def _cut(digest: Column) -> Column:
    return F.substring(F.hex(digest), 1, 2)


def stored_counts(spark: SparkSession, cache: str, version: str, cuts: list[str] | None = None) -> DataFrame:
    """``(digest, n_tokens)`` of all or of some cuts; a digest that two runs appended at once counts once."""
    path = f"{cache}/{version}"
    if not exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    rows = spark.read.schema(f"{SCHEMA}, cut string").parquet(path)
    if cuts is not None:
        rows = rows.filter(F.col("cut").isin(cuts))
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def append_missing(texts: DataFrame, cache: str, tokenizer: str, max_sent: int = MAX_SENT) -> DataFrame:
    """``(digest, n_tokens)`` of every distinct text of ``(digest, content)``; what the cache lacked is encoded and appended.

    Only digests are compared with the cache. If few are missing, they are sent to the
    scan, so that texts with a count never move; otherwise the texts are first
    combined by digest on the map side, so copies do not move either.
    """
    spark, version = texts.sparkSession, tokenizer_version(tokenizer)
    known = None
    if exists(spark, f"{cache}/{version}"):
        own = materialize(texts.select("digest").distinct())
        cuts = [r[0] for r in own.select(_cut(F.col("digest"))).distinct().collect()]  # 256 at most
        known = materialize(own.join(stored_counts(spark, cache, version, cuts), "digest", "left"))
        missing = known.filter(F.col("n_tokens").isNull()).select("digest")
        known = known.filter(F.col("n_tokens").isNotNull())
        n_missing = missing.count()
        if not n_missing:
            return known
        texts = texts.join(F.broadcast(missing) if n_missing * 32 <= max_sent else missing, "digest", "left_semi")
    distinct = texts.groupBy("digest").agg(F.first("content").alias("content"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer)
        for batch in batches:
            counts = [count([t.as_py()])[0] for t in batch.column("content")]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts, pa.int64())],
                                             ["digest", "n_tokens"])

    counted = materialize(distinct.mapInArrow(encode, SCHEMA))
    if not counted.isEmpty():
        cut = counted.withColumn("cut", _cut(F.col("digest")))
        cut.hint("rebalance", "cut").write.mode("append").partitionBy("cut").parquet(f"{cache}/{version}")
    return counted if known is None else known.unionByName(counted)


def count_tokens(docs: DataFrame, cache: str, tokenizer: str, text: str = "text",
                 normalise: Callable[[Column], Column] = as_is, limit: int = LIMIT) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit``, its text column included.

    ``cache`` is a folder that all executors share, ``tokenizer`` a ``.model`` or
    ``.json`` file on every machine. ``normalise`` is applied before digesting and encoding.
    """
    digest, held, size = fresh("digest"), fresh("count"), fresh("size")
    content = normalise(quoted(text))
    key = F.unhex(F.sha2(content.cast("binary"), 256))
    counts = append_missing(docs.select(key.alias("digest"), content.alias("content")), cache, tokenizer)
    # Computed anew, the key counts as no partitioning. Both sides then come
    # straight from an exchange, and adaptive execution can split a hot digest.
    counts = counts.select(F.concat("digest", F.unhex(F.lit(""))).alias(digest), F.col("n_tokens").alias(held))
    # The bytes are counted before the join, so that a caller who drops the text does not move it.
    n_bytes = F.octet_length(F.coalesce(quoted(text), F.lit(""))).cast("long")
    joined = docs.withColumns({digest: key, size: n_bytes}).join(counts, digest, "left")
    return joined.select(
        *others(docs, ("n_bytes", "n_tokens", "over_limit")), F.col(size).alias("n_bytes"),
        F.col(held).alias("n_tokens"), (F.col(held) > limit).alias("over_limit"))


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, through a cache of this run only: a query shall not depend on one before it."""
    import public_tokenizers

    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = count_tokens(docs, scratch_path(spark, "token-counts"), public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


QUERIES = {"op1_token_counts": op1_token_counts}
ORACLES: dict[str, str] = {}
