"""Quality rules kept as a ledger of bits, judged later by versioned policies.

Every rule is evaluated once per document. What was measured and which rules
failed (bit ``i`` of ``failed_bits`` for rule ``i`` of ``RULES``) are stored side
by side, so a changed policy, or the question what a rule alone costs, never reads
the texts again: both are bitwise work on one integer per document.

Null and empty texts have no words: all measurements are 0 and ``few_words`` fails.
Texts of any length are measured whole. Ties do not occur; repeated rows are judged alike; an empty table gives an empty
ledger. Input columns named like a ledger column are replaced by it.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from palate.llm.common import quoted, table, with_fields

WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_letter_words", "n_letters", "n_capitals")

#: Rule ``i`` owns bit ``i``; a document fails it where the condition holds. Only append:
#: stored ledgers refer to positions.
RULES = (
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "100 * n_dup_lines > 40 * n_lines"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 12 * n_words"),
    ("few_letters", "100 * n_letter_words < 70 * n_words"),
    ("capitals", "100 * n_capitals > 50 * n_letters"),
)
BIT = {name: 1 << place for place, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """Rejects a document that fails any rule of ``forbidden`` or over ``tolerated`` of ``counted``."""

    name: str
    version: int
    forbidden: tuple[str, ...]
    counted: tuple[str, ...] = ()
    tolerated: int = 0

    @property
    def forbidden_mask(self) -> int:
        return sum(BIT[r] for r in self.forbidden)

    @property
    def counted_mask(self) -> int:
        return sum(BIT[r] for r in self.counted)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
PROSE = Policy("prose", 1, ("few_words", "repeated_windows", "symbols", "repeated_lines"),
               ("word_length", "few_letters", "capitals"), tolerated=0)
LENIENT = Policy("prose", 2, ("few_words", "repeated_windows", "symbols"),
                 ("repeated_lines", "word_length", "few_letters", "capitals"), tolerated=1)
POLICIES = {(p.name, p.version): p for p in (BASE, PROSE, LENIENT)}

_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
_CAPITALS = bytes(range(65, 91))
_NOT_ASCII_LETTERS = bytes(b for b in range(256) if b not in _LETTERS)
_WORDY = bytes(b for b in range(256) if b > 127 or b in _LETTERS)
_NO_LETTERS = bytes(b for b in range(256) if b not in _WORDY)
_FACTORS = np.random.default_rng(8).integers(1, 2**63, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of 8 that occur at least twice, every occurrence counted.

    Equal windows have equal hashes, so only windows whose hash repeats are compared
    in full; the answer is exact.
    """
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    place = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.uint64, len(words))
    if len(ids) == len(words):
        return 0
    hashes = place[:n] * _FACTORS[0]
    for k in range(1, WINDOW):
        hashes += place[k:n + k] * _FACTORS[k]
    ordered = np.sort(hashes)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    spots = np.minimum(np.searchsorted(twice, hashes), len(twice) - 1)
    starts = np.flatnonzero(twice[spots] == hashes)
    windows = [place[s:s + WINDOW].tobytes() for s in starts]
    often = Counter(windows)
    edges = np.zeros(len(words) + 1, np.int64)
    for start, window in zip(starts, windows):
        if often[window] > 1:
            edges[start] += 1
            edges[start + WINDOW] -= 1
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def measure(text: bytes | None) -> tuple[int, ...]:
    """The ``MEASURES`` of one UTF-8 text."""
    text = text or b""
    words = text.split()
    bare = b"".join(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    letters = text.translate(None, _NOT_ASCII_LETTERS)
    return (len(words), len(bare.decode("utf-8", "replace")),
            len(text) - len(text.translate(None, b"#*$%&|<>")), len(lines), len(lines) - len(set(lines)),
            repeated_words(words), sum(1 for w in words if w.translate(None, _NO_LETTERS)),
            len(letters), len(letters) - len(letters.translate(None, _CAPITALS)))


def _measured(texts: pa.Array) -> pa.Array:
    columns = zip(*(measure(t.as_py()) for t in texts)) if len(texts) else [()] * len(MEASURES)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(MEASURES))


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measurements and ``failed_bits``.

    The function is marked non-deterministic only so that a filter on its result is
    not pushed below it, which would measure every text twice.
    """
    measures = F.arrow_udf(_measured, f"struct<{', '.join(f'{m}: bigint' for m in MEASURES)}>")
    measured = with_fields(docs, measures.asNondeterministic()(quoted(text).cast("binary")), MEASURES)
    bits = sum((F.when(F.expr(rule), F.lit(1 << place)).otherwise(F.lit(0)).cast("long")
                for place, (_, rule) in enumerate(RULES)), F.lit(0).cast("long"))
    return with_fields(measured, F.struct(bits.alias("failed_bits")), ["failed_bits"])


def accepted(policy: Policy, bits: Column | None = None) -> Column:
    """Whether ``policy`` keeps a document with these failure bits."""
    bits = F.col("failed_bits") if bits is None else bits
    few = F.bit_count(bits.bitwiseAND(F.lit(policy.counted_mask))) <= policy.tolerated
    return (bits.bitwiseAND(F.lit(policy.forbidden_mask)) == 0) & few


def ablation(judged: DataFrame, policy: Policy) -> DataFrame:
    """``(rule, n_failed, n_kept, n_kept_without)`` for every rule of ``policy``.

    The ledger is first counted by distinct bit pattern, combined map-side; the
    rest works on those few rows, however large the corpus.
    """
    patterns = judged.groupBy("failed_bits").agg(F.count("*").alias("n"))
    rules = [r for r, _ in RULES if r in policy.forbidden + policy.counted]
    each = patterns.withColumn("rule", F.explode(F.array(*(F.lit(r) for r in rules))))
    bit = F.element_at(F.create_map(*(F.lit(x) for r in rules for x in (r, BIT[r]))), F.col("rule")).cast("long")
    total = lambda kept: F.sum(F.when(kept, F.col("n")).otherwise(0))
    return (each.withColumn("bit", bit).groupBy("rule")
            .agg(total(F.col("failed_bits").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
                 total(accepted(policy)).alias("n_kept"),
                 total(accepted(policy, F.col("failed_bits").bitwiseAND(F.bitwise_not("bit"))))
                 .alias("n_kept_without")))


def failure_profile(judged: DataFrame, by: str) -> DataFrame:
    """Per value of ``by``: the rules failed by any document, and by all of them, as bits."""
    return judged.groupBy(by).agg(F.count("*").alias("n_docs"), F.bit_or("failed_bits").alias("any_bits"),
                                  F.bit_and("failed_bits").alias("all_bits"))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Every document judged by the prose policy."""
    judged = ledger(table(spark, folder, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         (~accepted(BASE)).alias("base_failed"),
                         (accepted(BASE) & accepted(PROSE)).alias("kept"), "failed_bits")


ORACLE_CTES = r"""
words AS (SELECT doc_id, coalesce(text, '') AS text,
                 regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM words WHERE len(w) >= 8)),
hits AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM hits) GROUP BY doc_id),
lined AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
          FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
measured AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
                    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                    coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
                    coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
                    len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z\x{80}-\x{10FFFF}]')))::BIGINT AS n_letter_words,
                    length(regexp_replace(text, '[^A-Za-z]', '', 'g'))::BIGINT AS n_letters,
                    length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals
             FROM words LEFT JOIN lined USING (doc_id) LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, """ + " + ".join(
    f"(CASE WHEN {rule} THEN {1 << place} ELSE 0 END)" for place, (_, rule) in enumerate(RULES)) + """ AS bits FROM measured)"""

QUERIES = {"op2_quality_rules": op2_quality_rules}
ORACLES = {"op2_quality_rules": f"""WITH {ORACLE_CTES}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, bits = 0 AS kept,
       bits::BIGINT AS failed_bits FROM judged"""}
