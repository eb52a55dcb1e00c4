import public_tokenizers
import sentencepiece
import pytest
from tokenizers import Tokenizer

from palate.llm import token_counts as tc

MODEL, JSON = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("path", [MODEL, JSON])
def test_counts_are_the_library_s(tricky, tmp_path, path):
    if path == MODEL:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t))
    else:
        model = Tokenizer.from_file(path)
        count = lambda t: len(model.encode(t, add_special_tokens=False).ids)
    rows = tc.count_tokens(tricky, str(tmp_path / "cache"), path).collect()
    assert len(rows) == tricky.count()
    for r in rows:
        assert r.n_tokens == count(r.text or "") and r.n_bytes == len((r.text or "").encode())
        assert r.over_limit == (r.n_tokens > tc.LIMIT)


def test_second_run_encodes_only_what_is_new(spark, tmp_path):
    cache, version = str(tmp_path / "cache"), tc.tokenizer_version(MODEL)
    first = spark.createDataFrame([(1, "alpha beta"), (2, "alpha beta"), (3, "gamma")], "doc_id int, text string")
    tc.count_tokens(first, cache, MODEL).collect()
    assert spark.read.parquet(f"{cache}/{version}").count() == 2
    # A stored count is taken as it is: nothing that was counted is encoded again.
    stored = spark.read.parquet(f"{cache}/{version}").withColumn("n_tokens", tc.F.lit(99).cast("long"))
    planted = str(tmp_path / "planted")
    stored.write.partitionBy("cut").parquet(f"{planted}/{version}")
    second = first.union(spark.createDataFrame([(4, "delta"), (5, None)], "doc_id int, text string"))
    got = {r.doc_id: r.n_tokens for r in tc.count_tokens(second, planted, MODEL).collect()}
    assert [got[i] for i in (1, 2, 3)] == [99, 99, 99] and got[4] not in (0, 99) and got[5] == 0
    assert spark.read.parquet(f"{planted}/{version}").count() == 4
    tc.append_missing(second.limit(0).selectExpr("unhex(sha2(text, 256)) AS digest", "text AS content"), planted, MODEL)
    assert spark.read.parquet(f"{planted}/{version}").count() == 4


def test_the_whole_table_through_a_cache_with_hits(spark, folder, tmp_path):
    """Every second document was counted before; the second run encodes the others, a third none, and writes nothing."""
    cache, docs = str(tmp_path / "cache"), spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    part = f"{cache}/{tc.tokenizer_version(MODEL)}"
    files = lambda: sorted(p.name for p in (tmp_path / "cache").rglob("*.parquet"))
    tc.count_tokens(docs.filter("doc_id % 2 = 0"), cache, MODEL).collect()
    before, n = files(), spark.read.parquet(part).count()
    rows = tc.count_tokens(docs, cache, MODEL).collect()
    assert set(files()) > set(before) and spark.read.parquet(part).count() == docs.select("text").distinct().count() > n
    after = files()
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in rows} == {d: len(model.encode(t)) for d, t in texts.items()}
    assert sorted(tc.count_tokens(docs, cache, MODEL).collect()) == sorted(rows) and files() == after


def test_a_run_reads_only_the_cuts_it_needs(spark, tmp_path):
    cache = str(tmp_path / "cache")
    many = spark.range(600).selectExpr("cast(id AS string) AS text")
    tc.count_tokens(many, cache, MODEL).collect()
    stored = tc.stored_counts(spark, cache, tc.tokenizer_version(MODEL), ["0A", "FF"])
    assert "PartitionFilters: [cut" in stored._jdf.queryExecution().executedPlan().toString()
    assert 0 < stored.count() < 60 and tc.stored_counts(spark, cache, tc.tokenizer_version(MODEL)).count() == 600


def test_columns_of_result_names_give_way(spark, tmp_path):
    docs = spark.createDataFrame([(1, "alpha beta", -1, "x", None)], "doc_id int, text string, N_BYTES int, n_tokens string, Over_Limit int")
    got = tc.count_tokens(docs, str(tmp_path / "cache"), MODEL)
    assert got.columns == ["doc_id", "text", "n_bytes", "n_tokens", "over_limit"]
    assert got.first().n_bytes == 10 and got.first().n_tokens > 0 and got.first().over_limit is False


@pytest.mark.parametrize("max_sent", [0, 1 << 20])
def test_many_missing_texts_take_the_other_way(spark, tmp_path, max_sent):
    cache, version = str(tmp_path / "cache"), tc.tokenizer_version(MODEL)
    for words in (["a"], ["a", "b", "b", "c"]):
        texts = spark.createDataFrame([(w,) for w in words], "content string").selectExpr("unhex(sha2(content, 256)) AS digest", "content")
        tc.append_missing(texts, cache, MODEL, max_sent)
    assert spark.read.parquet(f"{cache}/{version}").count() == 3


def test_empty_table(tricky, tmp_path):
    assert tc.count_tokens(tricky.limit(0), str(tmp_path / "cache"), MODEL).count() == 0


def test_query(spark, folder):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = tc.op1_token_counts(spark, folder).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {d: len(model.encode(t)) for d, t in texts.items()}
