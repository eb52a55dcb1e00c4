import collections
import hashlib
import math
import random

import brute
import pytest
from pyspark.sql import functions as F

from palate.llm import mixing


def water_filled(sizes):
    """Targets by resharing what is above three times a source's size, round by round."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, target = float(sum(sizes.values())), set(order), {}
    while True:
        share = left / max(1, sum(weight[s] for s in open_))
        over = {s for s in open_ if weight[s] * share > 3 * sizes[s]}
        if not over:
            return target | {s: weight[s] * share for s in open_}
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= over


def check(rows):
    sizes, taken, largest = collections.Counter(), collections.Counter(), collections.Counter()
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        assert r.taken in (r.size * k for k in range(4)) and (r.size == 0 or r.copies == r.taken // r.size)
    target = water_filled(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6


def test_targets_and_epochs(spark):
    rows = [(i, source, "w " * (1 + i % 7)) for source, n in (("a", 4), ("b", 300), ("é", 30), ("z", 50), (None, 10), ("B", 80))
            for i in range(n)]
    docs = spark.createDataFrame([(k, s, t) for k, (_, s, t) in enumerate(rows)], "doc_id bigint, source string, text string")
    first, again = (sorted(mixing.mix(d).collect(), key=lambda r: r.doc_id) for d in (docs, docs.repartition(7)))
    check(first)
    assert first == again
    assert {r.copies for r in first if r.source == "a"} == {3}  # complete epochs


def test_weights_decide_who_is_drawn(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("b").alias("source"), F.lit("w w").alias("text"),
                                    F.when(F.col("id") % 2 == 0, 4.0).otherwise(1.0).alias("quality"))
    docs = docs.union(spark.range(4000, 9000).select("id", F.lit("a"), F.lit("w w"), F.lit(1.0)))
    rows = [r for r in mixing.mix(docs, weight=F.col("quality")).collect() if r.source == "b"]
    extra = collections.Counter(r.quality for r in rows if r.copies > min(x.copies for x in rows))
    assert extra[4.0] > 1.5 * extra[1.0]


def test_every_case_has_a_result(spark, tricky):
    rows = mixing.mix(tricky).collect()
    check(rows)
    assert len(rows) == tricky.count()
    assert mixing.mix(tricky.limit(0)).count() == 0
    nothing = spark.createDataFrame([(1, "a", ""), (2, None, None)], "doc_id bigint, source string, text string")
    assert {(r.target, r.taken) for r in mixing.mix(nothing).collect()} == {(0.0, 0)}


def drawn_one_by_one(rows, weights=(5, 2, 1)):
    """Copies by the rule, document after document; ``rows``: (id, source, text, quality weight)."""
    def key(doc_id, weight):
        bits = int(hashlib.md5(f"mix-1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:13], 16)
        return -math.log((bits + 0.5) / (1 << 52)) / weight

    sized = [(i, s, len(brute.spaced(t)), key(i, w)) for i, s, t, w in rows]
    sizes = collections.Counter()
    for _, s, n, _ in sized:
        sizes[s] += n
    out = collections.Counter()
    for s, target in water_filled(sizes).items():
        epochs = int(target // sizes[s]) if sizes[s] else 0
        rest, at = target - epochs * sizes[s], 0
        for i, _, n, k in sorted((r for r in sized if r[1] == s), key=lambda r: (r[3], r[0] is not None, r[0], r[2])):
            out[i, s, n, (epochs + (at + n / 2 <= rest)) if n else 0] += 1
            at += n
    return out


@pytest.mark.parametrize("max_sent", [1 << 20, 0])
@pytest.mark.parametrize("seed", range(2))
def test_against_one_document_after_another(spark, seed, max_sent):
    """Small and large sources, weights, nulls, and a third of the rows on one source, one id or none."""
    draw = random.Random(seed)
    rows = [(i, draw.choice(["a", "b", "é", None]), "w " * draw.randint(0, 30), draw.choice([1.0, 0.2, 0.5])) for i in range(150)]
    rows += [(200 + i, "hot", "w " * draw.randint(1, 9), 1.0) for i in range(80)]
    rows += [(7, "b", "w " * (i + 1), 1.0) for i in range(60)] if seed % 2 else [(None, "b", "v " * (i + 1), 0.5) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string, q double")
    got = collections.Counter((r.doc_id, r.source, r.size, r.copies) for r in mixing.mix(docs, weight=F.col("q"), max_sent=max_sent).collect())
    assert got == drawn_one_by_one(rows)


@pytest.mark.parametrize("max_sent", [1 << 20, 0])
@pytest.mark.parametrize("doc_id", [7, None])
def test_rows_equal_in_all_are_taken_as_often_as_fits(spark, doc_id, max_sent):
    """A third of all rows are one row, and the target ends among them."""
    rows = [(doc_id, "a", "one two three", "x")] * 200 + [(1000 + i, "b", "w w w w", "y") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string, lang string").repartition(6)
    first = mixing.mix(docs, weights=(1.0, 4.0), max_sent=max_sent).collect()
    by_source = collections.Counter()
    for r in first:
        by_source[r.source] += r.taken
    targets = {r.source: r.target for r in first}
    assert len(first) == len(rows) and 0 < by_source["a"] < 600
    assert all(abs(by_source[s] - targets[s]) <= 2 for s in targets)
    again = mixing.mix(docs.repartition(3), weights=(1.0, 4.0), max_sent=max_sent).collect()
    assert sorted(map(str, again)) == sorted(map(str, first))


def test_equal_ids_are_told_apart_by_their_rows(spark):
    """Rows of one id and size but different text: a rerun takes the same ones."""
    rows = [(7, "a", f"w{i} x y", "l") for i in range(90)] + [(1000 + i, "b", "w w w", "l") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string, lang string")
    runs = [sorted((r.text, r.copies) for r in mixing.mix(d, weights=(1.0, 5.0)).collect()) for d in (docs, docs.repartition(9), docs.orderBy("text"))]
    assert runs[0] == runs[1] == runs[2] and {c for _, c in runs[0]} > {0}


def test_many_sources_reach_their_level(spark):
    """Targets come from cells of ratios; sources by the thousand, many of one size."""
    draw = random.Random(1)
    sizes = {f"s{i:05}": draw.choice([0, 1, 1, 2, 7, 7, 7, 1000, draw.randint(1, 10**6)]) for i in range(3000)}
    frame = spark.createDataFrame(list(sizes.items()), "src string, source_size bigint")
    got = {r.src: r.target for r in mixing.source_targets(frame).collect()}
    want = water_filled(sizes)
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s], rel=1e-9, abs=1e-9) for s in want)


def test_input_columns_named_like_results_give_way(spark):
    docs = spark.createDataFrame([(1, "a", "x y", -1, "t", None), (2, "b", "x", -1, "t", None)],
                                 "doc_id int, source string, text string, Size int, target string, `taken` int")
    got = mixing.mix(docs)
    assert got.columns == ["doc_id", "source", "text", *mixing.RESULTS]
    assert {(r.doc_id, r["size"]) for r in got.collect()} == {(1, 2), (2, 1)}


def plans_of(spark, docs, labels, monkeypatch, **options):
    plans, write = [], mixing.materialize
    monkeypatch.setattr(mixing, "materialize", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df))
    last = mixing.mix_by_quality(docs, labels, **options)
    last.collect()
    return plans, last._jdf.queryExecution().executedPlan().toString()


def test_texts_are_not_shuffled(spark, folder, monkeypatch):
    """Each of the three scans meets small tables only; nothing is sorted or windowed by source above a text."""
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    plans, last = plans_of(spark, docs, labels, monkeypatch)
    assert "Exchange hashpartitioning" not in last and "Window" not in last and "SortMergeJoin" not in last
    windows = [line for p in plans for line in p.splitlines() if "Window " in line or "Window [" in line]
    assert windows and not any("text" in line for line in windows)


@pytest.mark.parametrize("hot", ["id", "null", "source"])
def test_a_hot_key_is_split_in_large_tables(spark, monkeypatch, hot):
    """Beyond what is broadcast, a third of the rows on one id, on null or on one source does not meet in one task."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    key = F.when(F.col("id") % 3 == 0, {"id": 5, "null": None}.get(hot, F.col("id"))).otherwise(F.col("id"))
    docs = spark.range(12_000).select(key.cast("bigint").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("s"), F.col("id") % 200)).alias("source"), F.concat(F.lit("w w "), F.col("id")).alias("text")).repartition(16)
    labels = spark.range(6000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality")
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        plans, last = plans_of(spark, docs, labels, monkeypatch, max_sent=0)
        assert "skew=true" in last
        assert mixing.mix_by_quality(docs, labels, max_sent=0).count() == 12_000
    finally:
        for name in settings:
            spark.conf.unset(name)
