import random
import time

import brute
import pytest
from hypothesis import given, settings, strategies as st

from palate.llm import decontamination as dc
from palate.session import scratch_path

ITEMS = [("1", "The quick brown fox jumps over the lazy dog and then it sleeps for a while"), ("2", "short one"),
         ("3", "over the lazy dog and then it sleeps for a while longer"), ("4", ""), ("5", None), (None, "nameless item text")]


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id string, text string")


def documents(spark):
    texts = ["say: THE quick, brown-fox jumps over the lazy dog and then it sleeps for a while longer!", "a Short ONE here",
             "nothing", None, "", "nameless item text twice: nameless item text", "shortone", "é" * 9 + " short one é"]
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, N_HIT string")


@pytest.mark.parametrize("max_chars", [1 << 20, 60])
def test_against_brute_force(spark, benchmark, max_chars):
    for row in dc.mark(documents(spark), benchmark, max_chars=max_chars).collect():
        n_hit, ids = brute.hit_words(row.text, [i for i in ITEMS if i[1]])
        assert (row.n_words, row.n_hit, row.n_items) == (len(brute.plain(row.text)), n_hit, len(ids - {None}))
        assert {s.item_id for s in row.spans} == ids and row.contaminated == (n_hit > 0)
        for s in row.spans:
            assert brute.plain(row.text[s.start:s.end]) == brute.plain(row.text)[s.first_word:s.last_word + 1]


def spans_by_windows(words, item, window):
    """Words of ``words`` under windows of ``item``, one by one."""
    own = brute.runs(item, min(window, len(item))) if item else []
    hit = set()
    for run in own:
        for i in range(len(words) - len(run) + 1):
            if tuple(words[i:i + len(run)]) == run:
                hit |= set(range(i, i + len(run)))
    return hit


@given(st.lists(st.lists(st.sampled_from("abc"), max_size=14), max_size=4), st.lists(st.sampled_from("abcd"), max_size=60), st.integers(1, 7))
@settings(max_examples=300, deadline=None)
def test_blocks_find_every_window(items, words, window):
    """Few letters, so items overlap themselves and each other and blocks stand in many places."""
    matcher = dc.build([(str(i), " ".join(item).encode()) for i, item in enumerate(items)], window)
    n, spans = dc.scan(matcher, " ".join(words).encode())
    assert n == len(words)
    got = {}
    for s in spans:
        got.setdefault(s["item_id"], set()).update(range(s["first_word"], s["last_word"] + 1))
    want = {str(i): spans_by_windows(words, item, window) for i, item in enumerate(items)}
    assert got == {i: hit for i, hit in want.items() if hit}
    for i in got:  # spans neither meet nor overlap
        own = sorted((s["first_word"], s["last_word"]) for s in spans if s["item_id"] == i)
        assert all(b[0] > a[1] + 1 for a, b in zip(own, own[1:]))


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 300_000])
def test_symbols_are_told_apart_and_few_lead_on_from_the_start(n):
    symbols = list(dc.symbols_of(str(k).encode() for k in range(n)).values())
    firsts, seconds = {s[0] for s in symbols}, {s[1] for s in symbols}
    assert len(set(symbols)) == n and not firsts & seconds and dc.UNKNOWN[0] not in firsts | seconds
    assert max(len(firsts), len(seconds)) <= n**0.5 + 1


def test_a_long_copy_is_followed_once():
    """A text of 20,000 words that is an item itself: each of its 4,000 blocks stands, the run is walked once."""
    text = " ".join(f"w{i}" for i in range(20_000)).encode()
    matcher = dc.build([("a", text)], 10)
    began = time.perf_counter()
    assert dc.scan(matcher, text)[1][0]["last_word"] == 19_999
    assert time.perf_counter() - began < 2


def test_a_large_benchmark_is_one_automaton_and_one_scan(spark):
    """20 MB of benchmark: the documents are read by one scan, and not written in between."""
    draw = random.Random(3)
    words = ["".join(draw.choice("abcdefghij") for _ in range(7)) for _ in range(50_000)]
    items = [(i, " ".join(draw.choice(words) for _ in range(25_000))) for i in range(100)]
    assert sum(len(t) for _, t in items) > 19 << 20
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    docs = spark.createDataFrame([(1, items[7][1][100_000:101_000]), (2, "clean words here")], "doc_id int, text string")
    docs.write.parquet(path := scratch_path(spark, "docs"))
    marked = dc.mark(spark.read.parquet(path), benchmark)
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("ArrowEvalPython") == 1
    assert {r.doc_id: (r.n_hit > 100, r.n_items) for r in marked.collect()} == {1: (True, 1), 2: (False, 0)}


def test_equal_rows_of_the_benchmark_are_sent_once(spark):
    """Two thirds of the rows are one row; that does not make several automata of one."""
    rows = [("1", "one two three four")] * 50 + [("2", "five six seven")]
    docs = spark.createDataFrame([(1, "zero one two three four five six seven")], "doc_id int, text string")
    marked = dc.mark(docs, spark.createDataFrame(rows, "item_id string, text string"), max_chars=40)
    assert marked._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert marked.first().n_hit == 7 and marked.first().n_items == 2


def test_names_with_dots(spark):
    docs = spark.createDataFrame([(1, "one two")], "`doc.id` int, `the.text` string")
    benchmark = spark.createDataFrame([("i", "two")], "`item.id` string, `its.text` string")
    row = dc.mark(docs, benchmark, "the.text", "item.id", "its.text").first()
    assert (row["the.text"], row.n_hit, row.n_items) == ("one two", 1, 1)


def test_every_case_has_a_result(tricky, benchmark, spark):
    assert dc.mark(tricky, benchmark).count() == tricky.count()
    assert dc.mark(tricky.limit(0), benchmark).count() == 0
    nothing = dc.mark(tricky, benchmark.limit(0)).collect()
    assert {r.n_hit for r in nothing} == {0}
