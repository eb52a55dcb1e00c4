"""Benchmark passages found in documents by one scan with an Aho-Corasick automaton.

Both sides are folded to plain words, and every word of the benchmark is written as two characters, each of them one of about as many
as the root of the number of words: a state's ways on are searched one by one, and so there are few. The automaton reads a
document as such a string, in the pieces that words unknown to the benchmark leave of it. A window of ``window`` words holds a whole block of half as many that starts at a multiple of that in
its item, so the blocks, and items shorter than a window, are its patterns: two nodes for each word of the benchmark.
A document is read once, whatever the number of patterns; where a block stands, the
item's words around it are compared with the document's, and a run of a window or more is a match. Matches are reported as word
places and as code point offsets in the original text.

The benchmark is sent to all executors, so its size is checked first, after equal rows have been dropped: an automaton
takes some 28 bytes for each character of text, about 700 MB at ``max_chars``. A larger benchmark is dealt to several
automata, and the documents are scanned by one after the other from a written table. Nothing is left out.

Null and empty texts have no words and no hits, texts of any length are scanned whole; an item without words has no
windows; two items with one id count once; a null id marks words but is not listed.
Ties do not occur. Repeated documents get equal rows, empty tables give empty or clean results. Input
columns named like a result column are replaced by it.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from palate.llm.common import fresh, others, plain_offsets, plain_words, quoted, table, with_fields
from palate.session import materialize

WINDOW = 10
#: Characters of benchmark text for one automaton.
MAX_CHARS = 24 << 20
SPANS = "array<struct<item_id: string, first_word: bigint, last_word: bigint, start: bigint, end: bigint>>"
RESULTS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans")


#: Stands for all words that the benchmark does not have; no item holds it.
UNKNOWN = "\x01\x01"
#: Characters of a word, and where the second ones begin; no first one is among them, so no match begins between two.
WIDTH, SECOND = 2, 1 << 19


@dataclass
class Matcher:
    """Items as strings, and the automaton of their blocks; a block carries where it stands. ``least`` is the shortest block."""

    window: int
    symbols: dict[bytes, str]
    ids: list[str | None]
    items: list[str]
    automaton: ahocorasick.Automaton
    least: int


def symbols_of(words: Iterable[bytes]) -> dict[bytes, str]:
    """Two characters for each of the distinct words."""
    distinct = list(dict.fromkeys(words))
    base = math.isqrt(len(distinct)) + 1
    return {w: chr(2 + k // base) + chr(SECOND + k % base) for k, w in enumerate(distinct)}


def build(rows: list[tuple[str | None, bytes]], window: int) -> Matcher:
    kept = [(item, words) for item, text in dict.fromkeys(rows) if (words := plain_words(text))]
    symbols = symbols_of(w for _, words in kept for w in words)
    items = ["".join([symbols[w] for w in words]) for _, words in kept]
    block = (window + 1) // 2
    found: dict[str, list[tuple[int, int]]] = {}
    for k, item in enumerate(items):
        if len(item) < window * WIDTH:
            found.setdefault(item, []).append((k, 0))
        else:
            for at in range(0, len(item) - block * WIDTH + 1, block * WIDTH):
                found.setdefault(item[at:at + block * WIDTH], []).append((k, at))
    automaton = ahocorasick.Automaton()
    for key, places in found.items():
        automaton.add_word(key, (len(key), places))
    automaton.make_automaton()
    return Matcher(window, symbols, [i for i, _ in kept], items, automaton, min(map(len, found), default=0))


def blocks_in(matcher: Matcher, text: str) -> Iterator[tuple[int, tuple[int, list]]]:
    """Where blocks end. An unknown word takes the automaton back to its start, so the pieces between are read by themselves."""
    at = 0
    for piece in text.split(UNKNOWN):
        if len(piece) >= matcher.least:
            for last, block in matcher.automaton.iter(piece):
                yield at + last, block
        at += len(piece) + WIDTH


def runs(matcher: Matcher, text: str) -> Iterator[tuple[int, int, int]]:
    """(item, first word, last word) of the runs that an item and the document have in common, as long as they go.

    A run that was followed from one of its blocks is not followed again from the next.
    """
    ends: dict[tuple[int, int], int] = {}
    n = len(text)
    for last, (size, places) in blocks_in(matcher, text):
        first = last - size + 1
        for k, at in places:
            item = matcher.items[k]
            if len(item) < matcher.window * WIDTH:
                yield k, first // WIDTH, last // WIDTH
                continue
            gap = first - at
            if ends.get((k, gap), -1) >= last:
                continue
            a, z = first, last
            while a > 0 and a > gap and text[a - 1] == item[a - 1 - gap]:
                a -= 1
            while z + 1 < n and z + 1 - gap < len(item) and text[z + 1] == item[z + 1 - gap]:
                z += 1
            ends[k, gap] = z
            a, z = -(-a // WIDTH), (z + 1) // WIDTH - 1  # whole words
            if z - a + 1 >= matcher.window:
                yield k, a, z


def scan(matcher: Matcher, text: bytes | None) -> tuple[int, list[dict]]:
    """Number of words, and the spans of each item: overlapping and adjacent runs are joined."""
    words = plain_words(text)
    if not words or not len(matcher.automaton):
        return len(words), []
    text_of = "".join(map(matcher.symbols.get, words, repeat(UNKNOWN)))
    joined: dict[str | None, list[list[int]]] = {}
    for k, first, last in sorted(runs(matcher, text_of), key=lambda r: r[1:]):
        own = joined.setdefault(matcher.ids[k], [])
        if own and first <= own[-1][1] + 1:
            own[-1][1] = max(own[-1][1], last)
        else:
            own.append([first, last])
    if not joined:
        return len(words), []
    places = plain_offsets(text)
    points = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    return len(words), [
        {"item_id": item, "first_word": first, "last_word": last,
         "start": int(points[places[first][0]]), "end": int(points[places[last][1]])}
        for item, own in joined.items() for first, last in own]


_BUILT: dict[str, Matcher] = {}


def scanner(shared: Broadcast, window: int):
    """An Arrow function over texts; a Python worker builds the automaton once."""
    name = uuid.uuid4().hex

    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if name not in _BUILT:
            _BUILT.clear()
            _BUILT[name] = build(shared.value, window)
        matcher = _BUILT[name]
        kind = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([
            ("item_id", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()),
            ("start", pa.int64()), ("end", pa.int64())])))])
        for texts in batches:
            yield pa.array([dict(zip(("n_words", "spans"), scan(matcher, t.as_py()))) for t in texts], kind)

    return F.arrow_udf(scanned, f"struct<n_words: bigint, spans: {SPANS}>").asNondeterministic()


def mark(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
         item_text: str = "text", window: int = WINDOW, max_chars: int = MAX_CHARS) -> DataFrame:
    """``docs`` with ``RESULTS``; ``spans`` says which item was found where."""
    spark = docs.sparkSession
    items = benchmark.select(quoted(item_id).cast("string").alias("id"), quoted(item_text).cast("binary").alias("text"))
    items = materialize(items.filter(F.length("text") > 0).distinct())
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    parts = max(1, math.ceil(chars / max_chars))
    deal = F.pmod(F.xxhash64("id", "text"), F.lit(parts))
    held, out = fresh("spans"), docs.withColumn(fresh_words := fresh("words"), F.lit(0).cast("long"))
    out = out.withColumn(held, F.array().cast(SPANS))
    for part in range(parts):
        rows = items.filter(deal == part).collect()  # distinct rows, so a part is as large as the others
        shared = spark.sparkContext.broadcast([(r["id"], bytes(r["text"])) for r in rows])
        found = fresh("found")
        out = out.withColumn(found, scanner(shared, window)(quoted(text).cast("binary")))
        out = (out.withColumn(fresh_words, F.col(f"{found}.n_words"))
               .withColumn(held, F.concat(held, F.col(f"{found}.spans"))).drop(found))
        if part < parts - 1:
            out = materialize(out)
    # Words under any span: spans in order, each adding what lies beyond the furthest end so far.
    ordered = F.array_sort(F.transform(held, lambda s: F.struct(s["first_word"].alias("a"), s["last_word"].alias("z"))))
    hit = F.aggregate(
        ordered, F.struct(F.lit(-1).cast("long").alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["z"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), s["z"] - F.greatest(acc["end"], s["a"] - 1))).alias("n")),
        lambda acc: acc["n"])
    ids = F.array_sort(F.array_distinct(F.filter(F.transform(held, lambda s: s["item_id"]), lambda i: i.isNotNull())))
    fields = F.struct(F.col(fresh_words).alias("n_words"), hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
                      F.col(held).alias("spans"))
    marked = with_fields(out, fields, RESULTS)
    return marked.select(*others(marked, [held, fresh_words]))


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every document against the whole benchmark."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    marked = mark(docs, table(spark, folder, "benchmark"))
    return marked.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


QUERIES = {"op3_decontamination": op3_decontamination}
ORACLES = {"op3_decontamination": r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
pat AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM pat),
win AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
        FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, sizes WHERE len(w) >= k)),
hit AS (SELECT win.doc_id, win.i, win.k, pat.item_id FROM win JOIN pat USING (k, s)),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""}
