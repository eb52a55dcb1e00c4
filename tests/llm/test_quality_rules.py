import brute
import pytest
from hypothesis import given, settings, strategies as st

from palate.llm import quality_rules as qr

WORDS = st.lists(st.sampled_from(["a", "b", "c", "é"]), max_size=60)


@given(WORDS)
@settings(max_examples=200, deadline=None)
def test_repeated_words_against_brute_force(words):
    assert qr.repeated_words([w.encode() for w in words]) == brute.repeated_words(" ".join(words))


def test_measures():
    text = "Héllo wörld\n\n# x\n# x\nABC 12"
    assert dict(zip(qr.MEASURES, qr.measure(text.encode()))) == {
        "n_words": 8, "word_chars": 19, "n_symbols": 2, "n_lines": 4, "n_dup_lines": 1, "n_repeat_words": 0,
        "n_letter_words": 5, "n_letters": 14 - 0 - 1, "n_capitals": 4} | {"n_letters": len("HllowrldxxABC")}


def test_every_case_has_a_result(tricky):
    out = qr.ledger(tricky)
    assert {c.lower() for c in out.columns} == {c.lower() for c in tricky.columns} | {m for m in qr.MEASURES} | {"failed_bits"}
    rows = out.collect()
    assert len(rows) == tricky.count()
    for r in rows:
        assert r.n_words == len(brute.spaced(r.text))
        assert r.word_chars == sum(map(len, brute.spaced(r.text)))
        assert bool(r.failed_bits & qr.BIT["few_words"]) == (r.n_words < 20)
    assert qr.ledger(tricky.limit(0)).count() == 0


@pytest.mark.parametrize("policy", qr.POLICIES.values())
def test_ablation_counts_what_each_rule_costs(spark, folder, policy):
    judged = qr.ledger(spark.read.parquet(f"{folder}/documents.parquet")).cache()
    bits = [r.failed_bits for r in judged.select("failed_bits").collect()]

    def kept(b):
        return not b & policy.forbidden_mask and (b & policy.counted_mask).bit_count() <= policy.tolerated

    for row in qr.ablation(judged, policy).collect():
        bit = qr.BIT[row.rule]
        assert row.n_failed == sum(bool(b & bit) for b in bits)
        assert row.n_kept == sum(map(kept, bits))
        assert row.n_kept_without == sum(kept(b & ~bit) for b in bits)
    profile = qr.failure_profile(judged, "source").collect()
    assert sum(p.n_docs for p in profile) == len(bits)
    judged.unpersist()


def test_labelled_documents(spark, folder):
    """Of labelled documents with enough words, the prose policy keeps the good and drops the bad."""
    judged = qr.ledger(spark.read.parquet(f"{folder}/documents.parquet"))
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    rows = judged.join(labels, "doc_id").filter("n_words >= 20").withColumn("kept", qr.accepted(qr.PROSE)).collect()
    good, bad = [r.kept for r in rows if r.quality], [r.kept for r in rows if not r.quality]
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_names_with_dots_and_result_names(spark):
    docs = spark.createDataFrame([(1, "one two two", "x", 5)], "doc_id int, `the.text` string, N_WORDS string, failed_bits int")
    row = qr.ledger(docs, "the.text").first()
    assert (row["the.text"], row.n_words) == ("one two two", 3) and row.failed_bits & qr.BIT["few_words"]
