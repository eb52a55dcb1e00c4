import collections
import os
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as cp
from palate.llm import quality_rules as qr
from palate.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, folder):
    """What each stage returns, by name."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, docs, folder).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_against_brute_force(spark, folder, stages):
    docs = texts(spark.read.parquet(f"{folder}/documents.parquet"))
    benchmark = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert [stages[n].columns for n, _ in cp.STAGES[:-1]] == [COLUMNS] * 4

    def rejected(text):
        m = dict(zip(qr.MEASURES, qr.measure((text or "").encode())))
        return (m["n_words"] < 20 or 100 * brute.repeated_words(text) > 30 * m["n_words"]
                or 10 * m["n_symbols"] > m["n_words"] or 100 * m["n_dup_lines"] > 40 * m["n_lines"]
                or not 2 * m["n_words"] <= m["word_chars"] <= 12 * m["n_words"]
                or 100 * m["n_letter_words"] < 70 * m["n_words"] or 100 * m["n_capitals"] > 50 * m["n_letters"])

    docs = {d: t for d, t in docs.items() if not rejected(t)}
    assert texts(stages["quality rules"]) == docs
    docs = {d: docs[d] for d, c in brute.near_classes(docs).items() if c == d}
    assert texts(stages["near duplicates"]) == docs
    docs = {d: t for d, t in docs.items() if not brute.hit_words(t, benchmark)[0]}
    assert texts(stages["decontamination"]) == docs
    copies = collections.Counter(r.doc_id for r in stages["mixing"].collect())
    assert set(copies) <= set(docs) and max(copies.values()) <= 3
    ids = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows, start = sorted(stages["token files"].collect(), key=lambda r: r.start), 0
    assert collections.Counter(r.doc_id for r in rows) == copies
    for r in rows:
        own = np.array(ids.encode(docs[r.doc_id], add_special_tokens=False).ids + [2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(own), zlib.crc32(own))
        start += r.n_tokens


@pytest.mark.parametrize("stage", [s for _, s in cp.STAGES])
def test_every_case_has_a_result(spark, folder, tricky, stage):
    out = stage(spark, tricky, folder)
    assert stage == cp.STAGES[-1][1] or out.columns == tricky.columns
    out.collect()
    assert stage(spark, tricky.limit(0), folder).count() == 0


TAKEN = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letter_words", "n_letters", "n_capitals",
         "failed_bits", "n_hit", "n_items", "items_sha256", "contaminated", "spans", "size", "source_size", "target", "copies", "taken",
         "node", "proof", "bands", "least", "class_id", "n_docs", "keeper", "weight", "quality", "turn", "id", "key", "cell", "src")


@pytest.mark.parametrize("change", [str, str.upper, str.title])
@pytest.mark.parametrize("stage", [s for _, s in cp.STAGES[:-1]])
def test_callers_columns_keep_their_values(spark, folder, stage, change):
    """Columns named like anything a stage makes come through with what was in them."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id < 60")
    marked = docs.select("*", *(F.concat(F.lit(f"{name} of "), F.col("doc_id")).alias(change(name)) for name in TAKEN))
    out = stage(spark, marked, folder)
    assert out.columns == marked.columns
    rows = out.collect()
    assert rows
    own = {r.doc_id: r for r in marked.collect()}
    assert all(r == own[r.doc_id] for r in rows)


def test_the_last_stage_reads_past_other_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("doc_id < 20")
    wide = docs.select("*", *(F.lit("x").alias(c) for c in ("id", "tie", "start", "n_tokens", "ids_crc32", "part", "shard")))
    assert sorted(cp.tokens(spark, wide, folder).collect()) == sorted(cp.tokens(spark, docs, folder).collect())


def test_run(spark, folder, stages):
    assert sorted(cp.run(spark, folder).collect()) == sorted(stages["token files"].collect())
    assert len(cp.STAGES) == 5 and os.path.exists(cp.__file__)
