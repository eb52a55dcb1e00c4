import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, strategies as st

from palate.llm import substring_dedup as sd


@given(st.lists(st.integers(0, (1 << 63) - 1), max_size=50, unique=True), st.integers(0, 62))
def test_sorted_code_round_trip(values, shift):
    values = np.array(sorted({v >> shift for v in values}), np.uint64)
    assert sd.decode_sorted(sd.code_sorted(values)).tolist() == values.tolist()


def table_of(number, texts, first=0):
    return pa.table({"grp": pa.array([number] * len(texts), pa.int64()), "id": pa.array(range(first, first + len(texts)), pa.int64()),
                     "text": pa.array([t.encode() for t in texts], pa.binary())})


LAYOUTS = [sd.Layout(3, 20, 20, 0), sd.Layout(3, 30, 24, 2), sd.Layout(3, 51, 40, 5)]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_a_sketch_never_counts_too_low(layout):
    """Windows of two groups are all let through, whatever else falls into their cells; in wide sketches hardly anything else."""
    texts = [" ".join(f"w{(i * j) % 50}" for j in range(60)) for i in range(1, 40)]
    groups = [table_of(g, random.Random(g).sample(texts, 20) + [" ".join(f"own{g}x{k}" for k in range(200))], g * 30) for g in range(3)]
    sketches = pa.concat_tables([sd.sketch_rows(g, layout) for g in groups])
    masks = pa.concat_tables([sd.merge_sketches(sketches.filter(pa.compute.equal(sketches["segment"], s)), layout)
                              for s in sketches["segment"].unique()])
    shared = [sd.Group(g) for g in groups]
    for number, group in enumerate(shared):
        others = set(np.concatenate([x.prints for k, x in enumerate(shared) if k != number]).tolist())
        told = set(sd.estimated_repeated(group, masks.filter(pa.compute.equal(masks["grp"], number)), layout).tolist())
        want = {i for i, p in enumerate(group.prints.tolist()) if p in others}
        assert told >= want and (layout.entry_bits < 40 or told == want)


def test_dense_and_sparse_counts_agree():
    draw = np.random.default_rng(4)
    groups = [draw.integers(0, 4096, n).astype(np.uint64) for n in (300, 0, 5, 900)]
    want = [[any(c in set(o.tolist()) for k, o in enumerate(groups) if k != i) for c in g.tolist()] for i, g in enumerate(groups)]
    for cells in (4096, 1 << 40):
        assert [h.tolist() for h in sd.hit_by_several(groups, cells)] == want


@pytest.mark.parametrize("size", [1 << 30, 1 << 40, 1 << 47])
def test_a_group_s_sketch_stays_under_its_text(size):
    """At a gigabyte, a terabyte and 128 TB of text: fewer bytes than the group's own text, and under 10,000 rows."""
    words = np.random.default_rng(1).integers(0, 1 << 40, 1_200_000)
    texts = [" ".join(f"{w:x}"[:6] for w in words[i:i + 2000].tolist()) for i in range(0, len(words), 2000)]
    rows = table_of(0, texts)
    layout = sd.Layout.of(size, 200)
    sketch = sd.sketch_rows(rows, layout)
    assert sketch.num_rows < 10_000
    assert sum(len(e) for e in sketch["entries"].to_pylist()) + 16 * sketch.num_rows < sum(map(len, texts))


def test_work_is_cut_by_the_bytes_of_text():
    """Ten times the text under fixed partitions: as many more groups and buckets, each as large as before."""
    for partitions in (8, 200):
        for size in (1 << 36, 10 << 36, 100 << 36):
            layout = sd.Layout.of(size, partitions)
            assert size / layout.groups <= sd.GROUP_BYTES and size / (1 << layout.bucket_bits) <= sd.BUCKET_BYTES
            assert layout.entry_bits - layout.segment_bits <= 12
            assert (1 << layout.entry_bits - 2 * sd.BLOCK_BITS) * (1 << sd.BLOCK_BITS) >= size * sd.CELLS_PER_BYTE
    assert sd.Layout.of(0, 1).groups >= 1


def test_twice_the_rows_are_dealt_to_twice_the_groups(spark, monkeypatch):
    """Under the same partitions; what a task holds stays bounded."""
    monkeypatch.setattr(sd, "GROUP_BYTES", 20_000)
    monkeypatch.setattr(sd, "GROUPS_PER_PARTITION", 0)
    texts = [" ".join(f"t{i}w{k}" for k in range(100)) for i in range(800)]
    largest = []
    for n in (400, 800):
        df = spark.createDataFrame(list(enumerate(texts[:n])), "doc_id bigint, text string")
        layout = sd.Layout.of(sum(map(len, texts[:n])), 8)
        sizes = df.selectExpr(f"pmod(xxhash64(doc_id, text), {layout.groups}) AS g", "length(text) AS n").groupBy("g").sum("n").collect()
        largest.append(max(r[1] for r in sizes))
        check(df)
    assert max(largest) < 3 * 20_000


def test_prints_that_differ_in_their_second_half_only_are_told_apart():
    p, s = np.array([7, 7, 7, 9], np.uint64), np.array([1, 2, 1, 1], np.uint64)
    assert sd.smallest_ids(p, s, np.array([5, 1, 3, 0])).tolist() == [3, 1, 3, 0]
    known = np.array([[7, 2], [7, 3], [8, 1]], np.uint64)
    assert sd.found_in(p, s, known).tolist() == [False, True, False, False]
    rows = pa.table({"grp": pa.array([0, 1], pa.int64()), "prints": [np.array([[7, 1], [7, 2]], "<u8").tobytes(), np.array([[7, 2]], "<u8").tobytes()],
                     "firsts": [np.array([4, 4], "<i8").tobytes(), np.array([2], "<i8").tobytes()]})
    assert [np.frombuffer(x, "<u8").tolist() for x in sd.group_exactly(rows)["later"].to_pylist()] == [[7, 2], []]


def check(df):
    docs = {r.doc_id: r.text for r in df.collect()}
    gone = brute.removed_words({(1 << 70) if d is None else d: t for d, t in docs.items()})
    rows = sd.dedup_substrings(df).collect()
    assert len(rows) == df.count()
    for r in rows:
        flags, words = gone[(1 << 70) if r.doc_id is None else r.doc_id], brute.spaced(docs[r.doc_id])
        assert (r.n_words, r.n_removed) == (len(words), sum(flags))
        assert r.kept_text == " ".join(w for w, f in zip(words, flags) if not f)


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    draw = random.Random(seed)
    passages = [[draw.choice("abcdefgh") for _ in range(draw.randint(10, 40))] for _ in range(6)]
    rows = []
    for i in draw.sample(range(1000), 60):
        words = [w for _ in range(draw.randint(0, 5)) for w in draw.choice(passages) + [draw.choice("xyz") + str(draw.random())]]
        rows.append((i, " ".join(words) or None))
    check(spark.createDataFrame(rows, "doc_id bigint, text string"))


def test_equal_ids_keep_their_words(spark):
    """Documents of one id, null included, lose words to smaller ids only, never to each other."""
    text, other = (" ".join(f"{k}{i}" for i in range(20)) for k in "ab")
    rows = [(5, text), (5, text), (5, text + " tail"), (None, other), (None, other), (9, text), (9, other), (3, "short")]
    got = sorted(((r.doc_id or 99), r.n_words, r.n_removed) for r in sd.dedup_substrings(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == [(3, 1, 0), (5, 20, 0), (5, 20, 0), (5, 21, 0), (9, 20, 0), (9, 20, 20), (99, 20, 20), (99, 20, 20)]


def test_every_case_has_a_result(spark, tricky):
    check(tricky.dropDuplicates(["doc_id"]))
    assert sd.dedup_substrings(tricky).count() == tricky.count()
    assert sd.dedup_substrings(tricky.limit(0)).count() == 0
