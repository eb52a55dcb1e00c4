import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from palate.llm import near_dups as nd


def expected(rows):
    classes = brute.near_classes(rows)
    return {d: d if not brute.plain(t) else classes[d] for d, t in rows.items()}


def classes(df):
    return {r.doc_id: r.class_id for r in nd.near_duplicates(df).collect()}


def test_registers_estimate_probability_jaccard():
    draw = np.random.default_rng(1)
    prints = draw.integers(0, 2**63, 300, dtype=np.uint64)
    x, y = draw.integers(1, 5, 200), draw.integers(1, 5, 200)
    docs = np.repeat([0, 1], 200)
    agree = []
    for seed in range(40):
        sig = nd.signatures(docs, np.concatenate((prints[:200], prints[50:250])), np.concatenate((x, y)).astype(float), 2, seed)
        agree.append((sig[0] == sig[1]).mean())
    a, b = dict(zip(prints[:200].tolist(), x.tolist())), dict(zip(prints[50:250].tolist(), y.tolist()))
    assert np.mean(agree) == pytest.approx(brute.probability_jaccard(a, b), abs=0.025)


@pytest.mark.parametrize("high", [1, 4])
def test_exact_similarity(high):
    draw = np.random.default_rng(high)
    for _ in range(30):
        x, y = ({int(k): int(draw.integers(1, high + 1)) for k in draw.choice(60, draw.integers(1, 50), False)} for _ in range(2))
        packed = [nd.pack(np.array(sorted(s), np.uint64), np.array([s[k] for k in sorted(s)])) for s in (x, y)]
        assert nd.similarity(*packed) == pytest.approx(brute.probability_jaccard(x, y))


def edited(words, draw, n):
    words = list(words)
    for _ in range(n):
        words[draw.randrange(len(words))] = f"new{draw.random()}"
    return words


def test_groups_against_brute_force(spark):
    draw, rows = random.Random(5), {}
    for _ in range(12):
        base = [f"w{draw.randrange(400)}" for _ in range(draw.randint(30, 200))]
        for _ in range(draw.choice([1, 2, 5, 30])):
            rows[draw.randrange(10**9)] = " ".join(edited(base, draw, draw.randrange(4)))
    for d in list(rows)[:10]:
        rows[draw.randrange(10**9)] = rows[d].upper() + " !"
    df = spark.createDataFrame(list(rows.items()), "doc_id bigint, text string")
    assert classes(df) == expected(rows)


def test_large_buckets_are_finished(spark, monkeypatch):
    """Chains through a shared passage: the star alone misses links, fresh bands find them."""
    monkeypatch.setattr(nd, "LARGE_BUCKET", 5)
    draw, rows = random.Random(6), {}
    shared = [f"s{i}" for i in range(60)]
    for k in range(8):
        base = shared + [f"b{k}x{i}" for i in range(40)]
        for _ in range(6):
            rows[len(rows)] = " ".join(edited(base, draw, 2))
    df = spark.createDataFrame(list(rows.items()), "doc_id bigint, text string")
    assert classes(df) == expected(rows)


@pytest.mark.parametrize("size, high", [(2048, 1), (7, 1), (7, 3)])
def test_links_within_a_bucket_against_all_pairs(monkeypatch, size, high):
    monkeypatch.setattr(nd, "LARGE_BUCKET", size)
    monkeypatch.setattr(nd, "COLUMNS", 64)
    draw = np.random.default_rng(size + high)
    bases, sets = [draw.integers(0, 2**63, 60, dtype=np.uint64) for _ in range(4)], []
    for _ in range(40):
        own = bases[draw.integers(4)].copy()
        own[:draw.integers(0, 12)] = draw.integers(0, 2**63, 1, dtype=np.uint64)
        prints = np.unique(own)
        sets.append(nd.pack(prints, draw.integers(1, high + 1, len(prints)) if high > 1 else np.ones(len(prints), int)))
    roots = [0, 0, 0, *range(3, 40)]
    joined = lambda pairs: {tuple(sorted(c)) for c in brute.grouped(range(40), [*pairs, (0, 1), (1, 2)])}
    every = [(a, b) for a in range(40) for b in range(a) if nd.similarity(sets[a], sets[b]) >= nd.THRESHOLD - 1e-12]
    found = nd.links_within(list(range(40)), roots, sets)
    assert joined(found) == joined(every) and len(found) < 40


def test_no_task_holds_a_large_bucket(spark, monkeypatch):
    """A bucket of many sizes of LARGE_BUCKET: every pair of two components meets, in bounded tasks."""
    monkeypatch.setattr(nd, "LARGE_BUCKET", 64)
    draw = random.Random(9)
    rows, root = [], {}
    for bucket, many in ((1, 900), (2, 0)):
        for i in range(1500):
            node = draw.getrandbits(60)
            root[node] = 7 if i < many else 8 if i < many + 100 else node if i % 2 else 11 + i // 40
            rows.append((bucket, node, root[node], 1500))
    open_ = spark.createDataFrame(rows, "bucket bigint, node bigint, root bigint, n bigint")
    met = {1: set(), 2: set()}
    for tasks_of in (nd._whole_tasks, nd._cross_tasks):
        tasks = {}
        for r in tasks_of(open_).collect():
            tasks.setdefault((r.bucket, r.task), ([], []))[r.side].append(r.node)
        assert len(tasks) > 30 and max(len(a) + len(b) for a, b in tasks.values()) <= 1.5 * nd.LARGE_BUCKET
        if tasks_of is nd._cross_tasks:
            for (bucket, _), (a, b) in tasks.items():
                met[bucket].update(frozenset((x, y)) for x in a for y in b or a if root[x] != root[y])
                assert not b or len({root[x] for x in a + b}) > 1
    for bucket in met:
        of = [r[1] for r in rows if r[0] == bucket]
        assert met[bucket] == {frozenset((x, y)) for i, x in enumerate(of) for y in of[:i] if root[x] != root[y]}


def test_components(spark):
    draw = random.Random(2)
    edges = [(a, draw.randrange(max(0, a - 3), a + 1)) for a in range(0, 400) if a % 50] + [(7, 7)]
    root = {}
    for a in range(400):
        root[a] = a
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    got = {r.node: r.root for r in nd.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {a: find(a) for a in got} and set(got) == {x for e in edges for x in e if e[0] != e[1]}


def test_no_node_s_ties_meet_in_a_window(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(nd, "materialize", lambda df, own=nd.materialize: (
        plans.append(df._jdf.queryExecution().optimizedPlan().toString()), own(df))[1])
    edges = spark.createDataFrame([(1, n) for n in range(2, 60)] + [(n, n + 100) for n in range(2, 60)], "a bigint, b bigint")
    got = {r.node: r.root for r in nd.components(edges).collect()}
    assert len(got) == 117 and set(got.values()) == {1}
    assert len(plans) > 1 and not any("Window" in p for p in plans)


def test_every_case_has_a_result(spark, tricky):
    rows = nd.near_duplicates(tricky).collect()
    assert len(rows) == tricky.count()
    unique = tricky.dropDuplicates(["doc_id"]).filter("doc_id IS NOT NULL")
    assert classes(unique) == expected({r.doc_id: r.text for r in unique.collect()})
    assert nd.near_duplicates(tricky.limit(0)).count() == 0
    kept = nd.one_of_each(tricky)
    assert kept.columns == tricky.columns
    texts = [tuple(brute.plain(r.text)) for r in kept.collect() if brute.plain(r.text)]
    assert len(texts) == len(set(texts))
    assert kept.filter(F.coalesce("text", F.lit("")) == "").count() == tricky.filter(F.coalesce("text", F.lit("")) == "").count()


def test_query_against_brute_force(spark, folder):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r.doc_id: r.class_id for r in nd.op10_near_dups(spark, folder).collect()}
    assert got == expected(rows)


@pytest.mark.parametrize("bits", [2, 5])
def test_hashes_that_clash_do_not_merge_documents(spark, bits):
    """A few bits of hash for all documents: they are told apart by their proofs, in every step."""
    draw, rows = random.Random(bits), {}
    for _ in range(8):
        base = [f"w{draw.randrange(400)}" for _ in range(60)]
        for _ in range(4):
            rows[draw.randrange(10**9)] = " ".join(edited(base, draw, draw.randrange(3)))
    for d in list(rows)[:6]:
        rows[draw.randrange(10**9)] = rows[d].upper()
    rows[-1] = None
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows.items()], "doc_id bigint, text string, node int, Proof int")
    assert nd.describe(df, bits=bits).clashes.count() > 0
    assert {r.doc_id: r.class_id for r in nd.near_duplicates(df, bits=bits).collect()} == expected(rows)
    kept = nd.one_of_each(df, bits=bits)
    assert kept.columns == df.columns and {(r.node, r.Proof) for r in kept.collect()} == {(1, 2)}
    assert {r.doc_id for r in kept.collect()} == set(expected(rows).values())
    assert nd.describe(df).clashes is None


def test_texts_are_hashed_twice_for_the_classes(spark, folder, monkeypatch):
    """Once for the signatures and once for the candidates' shingles; the result reads what was written."""
    plans = []
    monkeypatch.setattr(nd, "materialize", lambda df, own=nd.materialize: (
        plans.append(df._jdf.queryExecution().executedPlan().toString()), own(df))[1])
    last = nd.op10_near_dups(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert sum("documents.parquet" in p for p in plans) == 2 and "documents.parquet" not in last
