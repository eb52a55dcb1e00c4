"""Near copies by ProbMinHash signatures, banding and exact verification.

A document is its shingles of five folded words, weighted by their counts. Each shingle
is a Poisson process whose rate is its weight: its arrivals hit random registers, and
a register keeps the shingle that came first. Two signatures agree in a register with
the probability Jaccard similarity of the documents. Arrivals that come later than
the latest register are never generated, so a document of many shingles costs
little more than one pass.

1. Equal word sequences are one node; copies are never compared.
2. Registers are hashed in bands. Nodes that share a band are candidates. Each is first
   compared with one other only: of those it shares a band with, the one that shares bands
   with most. In a group of near copies that is one close to the original, and most of the
   others link to it.
3. Links of exact similarity ``THRESHOLD`` or more are contracted to components.
4. Buckets that still hold several components are finished: the members of a bucket meet in one
   task, which compares all of them by products of their incidence matrix and returns no
   more links than join its components. A bucket of over ``LARGE_BUCKET`` nodes is dealt to
   blocks, first each a task of its own. What then still holds several components is dealt
   anew, large components to blocks of their own, and every two blocks meet in a task unless
   they are of one component. So no pair of a bucket is left out for its size, no task
   holds more than about ``LARGE_BUCKET`` nodes, and no pairs of documents are written or shuffled.

A pair at similarity 0.8 shares a band with probability 1 - 2e-4, at 0.85 with 1 - 1e-6.
A node is a 64-bit hash of the words, proved by another: where documents of one hash differ in their proofs, all but those
of the smallest get a number of their own, so word sequences are told apart by 128 bits.

Texts of one to four words have one shingle, all their words. Null and empty texts have none and
are a class of their own each; texts of any length are read whole. A null id never names a class that has another id;
rows with equal ids are compared like any others, repeated rows are copies. An empty table gives an empty result. Columns
other than id and text have no influence and are kept by ``one_of_each``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from palate.llm.common import folded, fresh, quoted, table
from palate.llm.hashing import fold, mixed, word_hashes
from palate.operators.joins import lookup
from palate.session import materialize

SHINGLE = 5
THRESHOLD = 0.8
REGISTERS, BANDS, ROWS = 256, 36, 7
#: Nodes of a bucket that are compared in one task; larger buckets are dealt to blocks.
LARGE_BUCKET = 2048
#: Shingles of a block of the incidence matrix.
COLUMNS = 4096
#: Bytes of node ids that may be sent to the scan which fetches their texts.
MAX_SENT = 64 << 20
_RANDOM = np.random.default_rng(10)
_FACTORS = _RANDOM.integers(1, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_FACTORS = _RANDOM.integers(1, 2**63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def weighted_shingles(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, count), by document, then by shingle, from the hashes of all words."""
    ends = np.cumsum(sizes)
    starts = np.ones(len(hashes), bool)
    short = []
    for doc, (end, size) in enumerate(zip(ends.tolist(), sizes.tolist())):
        starts[max(end - size, end - SHINGLE + 1):end] = False
        if 0 < size < SHINGLE:
            short.append((doc, fold(hashes[end - size:end], _FACTORS[:size])[0]))
    at = np.flatnonzero(starts)
    prints = fold(hashes, _FACTORS)[at] if len(at) else np.empty(0, np.uint64)
    docs = np.concatenate((np.searchsorted(ends, at, "right"), [d for d, _ in short])).astype(np.int32)
    prints = np.concatenate((prints, np.array([p for _, p in short], np.uint64)))
    order = np.argsort(prints)
    order = order[np.argsort(docs[order], kind="stable")]
    docs, prints = docs[order], prints[order]
    heads = np.flatnonzero(np.concatenate(([True], (prints[1:] != prints[:-1]) | (docs[1:] != docs[:-1])))) \
        if len(docs) else np.empty(0, np.int64)
    return docs[heads], prints[heads], np.diff(np.append(heads, len(docs)))


def signatures(docs: np.ndarray, prints: np.ndarray, weights: np.ndarray, n_docs: int, seed: int = 0) -> np.ndarray:
    """ProbMinHash of every document: for each register, the shingle that arrives there first.

    Round ``i`` draws the i-th arrival of every shingle that can still change a register: its
    time goes up by an exponential gap over its weight, and it stops for good once that
    is later than all registers of its document.
    """
    times = np.full(n_docs * REGISTERS, np.inf)
    first = np.zeros(n_docs * REGISTERS, np.uint64)
    base, clock = docs.astype(np.int64) * REGISTERS, np.zeros(len(docs))
    alive = np.arange(len(docs))
    turn = 0
    while len(alive):
        turn += 1
        bits = mixed(prints[alive] ^ mixed(np.full(1, (seed << 32) + turn, np.uint64)))
        clock[alive] -= np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)) / weights[alive]
        spots = base[alive] + (bits & np.uint64(REGISTERS - 1)).astype(np.int64)
        near = clock[alive] < times[spots]
        spots, who = spots[near], alive[near]
        np.minimum.at(times, spots, clock[who])
        won = times[spots] == clock[who]
        first[spots[won]] = prints[who[won]]
        # Latest register of each document that is still in play; ``alive`` is ordered by document.
        own = docs[alive]
        heads = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        latest = times.reshape(n_docs, REGISTERS)[own[heads]].max(axis=1)
        alive = alive[clock[alive] < np.repeat(latest, np.diff(np.append(heads, len(own))))]
    return first.reshape(n_docs, REGISTERS)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    rows = signature[:, :BANDS * ROWS].reshape(-1, BANDS, ROWS)
    return mixed((mixed(rows) * _BAND_FACTORS).sum(axis=2, dtype=np.uint64))


def pack(prints: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending shingles, then their counts unless all are 1, after the number of shingles."""
    tail = b"" if (counts == 1).all() else counts.astype("<u4").tobytes()
    return len(prints).to_bytes(4, "little") + prints.astype("<u8").tobytes() + tail


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray | None]:
    n = int.from_bytes(packed[:4], "little")
    counts = np.frombuffer(packed, "<u4", n, 4 + 8 * n) if len(packed) > 4 + 8 * n else None
    return np.frombuffer(packed, "<u8", n, 4), counts


def similarity(a: bytes, b: bytes) -> float:
    """Exact probability Jaccard: over common i, the sum of 1 / sum_j max(x_j / x_i, y_j / y_i)."""
    (left, x), (right, y) = unpack(a), unpack(b)
    at = np.minimum(np.searchsorted(right, left), len(right) - 1)
    common = right[at] == left
    shared = int(common.sum())
    if x is None and y is None:
        return shared / (len(left) + len(right) - shared)
    if not shared:
        return 0.0
    x = np.ones(len(left)) if x is None else x.astype(float)
    y = np.ones(len(right)) if y is None else y.astype(float)
    alone = np.ones(len(right), bool)
    alone[at[common]] = False
    # Terms j take x_j / x_i where x_j / y_j is at least x_i / y_i, else y_j / y_i.
    xs, ys = x[common], y[at[common]]
    order = np.argsort(xs / ys, kind="stable")
    xs, ys = xs[order], ys[order]
    ratio = xs / ys
    below = np.searchsorted(ratio, ratio, "left")
    x_from = np.concatenate((np.cumsum(xs[::-1])[::-1], [0.0]))[below] + x[~common].sum()
    y_to = np.concatenate(([0.0], np.cumsum(ys)))[below] + y[alone].sum()
    return float((1.0 / (x_from / xs + y_to / ys)).sum())


def nodes_of(hashes: np.ndarray, sizes: np.ndarray, salt: int = 0) -> np.ndarray:
    """The node of each word sequence, 0 without words: its words' hashes, each mixed with its place, added up."""
    starts = np.cumsum(sizes) - sizes
    place = (np.arange(len(hashes)) - np.repeat(starts, sizes)).astype(np.uint64) + np.uint64(salt << 40)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(hashes + mixed(place)))))
    return np.where(sizes > 0, mixed(sums[starts + sizes] - sums[starts]).view(np.int64), 0)


def _hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes([folded(t.as_py()) for t in texts])


def _identity(hashes: np.ndarray, sizes: np.ndarray, bits: int) -> list[pa.Array]:
    """Node and proof, null without words; of the node only ``bits`` are used."""
    none = sizes == 0
    node = nodes_of(hashes, sizes) >> np.int64(64 - bits)
    return [pa.array(node, pa.int64(), mask=none), pa.array(nodes_of(hashes, sizes, 1), pa.int64(), mask=none)]


def _identities(bits: int):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [pa.StructArray.from_arrays(_identity(*_hashed(texts[at:at + 512]), bits), names=["node", "proof"])
                     for at in range(0, len(texts), 512)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.struct([("node", pa.int64()), ("proof", pa.int64())]))

    return F.arrow_udf(run, "struct<node: bigint, proof: bigint>").asNondeterministic()


def _described(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, node, proof, bands) of (id, text)."""
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                piece = batch.slice(at, 512)
                hashes, sizes = _hashed(piece.column("text"))
                docs, prints, counts = weighted_shingles(hashes, sizes)
                keys = band_keys(signatures(docs, prints, counts.astype(float), len(sizes))).view(np.int64)
                node, proof = _identity(hashes, sizes, bits)
                yield pa.RecordBatch.from_pydict({
                    "id": piece.column("id"), "node": node, "proof": proof,
                    "bands": pa.array([k.tolist() if n else [] for k, n in zip(keys, sizes)], pa.list_(pa.int64()))})

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, shingles) of (node, text)."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            piece = batch.slice(at, 512)
            docs, prints, counts = weighted_shingles(*_hashed(piece.column("text")))
            edges = np.searchsorted(docs, np.arange(piece.num_rows + 1))
            yield pa.RecordBatch.from_pydict({
                "node": piece.column("node"),
                "shingles": pa.array([pack(prints[a:z], counts[a:z]) for a, z in zip(edges[:-1], edges[1:])], pa.binary())})


def _similarities(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([similarity(x.as_py(), y.as_py()) for x, y in zip(a, b)], pa.float64())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(a, b)``; the root is the smallest node.

    Alternates two steps until every tie leads to a root: every node's larger neighbours
    are tied to its smallest one, then its smaller ones are. Only minima are gathered for a
    node, combined map-side, and a hub's edges are split by adaptive execution.
    """
    ties = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    while True:
        ties = materialize(ties)
        ends = ties.select(F.col("u").alias("node"), F.lit(1).alias("up")).union(ties.select("v", F.lit(0)))
        loose = (ends.groupBy("node").agg(F.sum("up").alias("ups"), F.count("*").alias("n"))
                 .filter("ups > 1 OR (ups = 1 AND n > 1)"))
        if loose.isEmpty():  # every node has one tie upwards or only ties from below
            break
        both = ties.union(ties.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (lookup(both.filter("v > u"), least, "u", "inner")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = materialize(large)
        small = lookup(large, large.groupBy("u").agg(F.min("v").alias("m")), "u", "inner")
        # A node with one tie keeps it; of several, the other ends are tied to the smallest.
        ties = (small.select(F.explode(F.when(F.col("v") == F.col("m"), F.array(F.struct("u", F.col("m").alias("v"))))
                                       .otherwise(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))).alias("t"))
                .select("t.u", "t.v").distinct())
    return ties.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        ties.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` of exact similarity ``THRESHOLD`` or more."""
    right = pairs.join(sets.withColumnsRenamed({"node": "b", "shingles": "of_b"}), "b")
    both = right.join(sets.withColumnsRenamed({"node": "a", "shingles": "of_a"}), "a")
    score = F.arrow_udf(_similarities, "double").asNondeterministic()
    scored = both.select("a", "b", score("of_a", "of_b").alias("similarity"))
    return materialize(scored.filter(F.col("similarity") >= THRESHOLD - 1e-12))


def _several(buckets: DataFrame) -> DataFrame:
    """``(bucket, n)`` of the buckets that hold more than one node."""
    return (buckets.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("n"))
            .filter("low <> high").select("bucket", "n"))


def _first_pairs(buckets: DataFrame) -> DataFrame:
    """``(a, b)``: every node ``b`` with the candidate ``a`` that shares most bands with others."""
    weights = buckets.groupBy("node").agg(F.sum(F.col("n") - 1).alias("weight"))
    weighed = lookup(buckets.select("bucket", "node"), weights, "node", "inner")
    best = weighed.groupBy("bucket").agg(F.max(F.struct("weight", "node")).alias("best"))
    paired = lookup(weighed, best, "bucket", "inner").filter("best.node <> node")
    return (paired.groupBy(F.col("node").alias("b")).agg(F.max("best").alias("best"))
            .select(F.col("best.node").alias("a"), "b"))


def _open(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """``(bucket, node, root, n)`` of the buckets that hold more than one component."""
    rooted = (buckets.select("bucket", "node").join(roots, "node", "left")
              .select("bucket", "node", F.coalesce("root", "node").alias("root")))
    several = (rooted.groupBy("bucket")
               .agg(F.min("root").alias("first"), F.max("root").alias("last"), F.count("*").alias("n"))
               .filter("first <> last").select("bucket", "n"))
    return lookup(rooted, several, "bucket", "inner")


def _shared_mass(docs: np.ndarray, columns: np.ndarray, weights: np.ndarray, rows: range, others: range) -> np.ndarray:
    """For each pair of ``rows`` and ``others``: the weight in the row of the shingles that both have."""
    mass = np.zeros((len(rows), len(others)), np.float32)
    for first in range(0, int(columns[-1]) + 1 if len(columns) else 0, COLUMNS):
        a, z = np.searchsorted(columns, [first, first + COLUMNS])
        left, right = (np.zeros((len(r), COLUMNS), np.float32) for r in (rows, others))
        doc, column = docs[a:z], columns[a:z] - first
        own = (doc >= rows.start) & (doc < rows.stop)
        left[doc[own] - rows.start, column[own]] = weights[a:z][own]
        own = (doc >= others.start) & (doc < others.stop)
        right[doc[own] - others.start, column[own]] = 1
        mass += left @ right.T
    return mass


def links_within(nodes: list[int], roots: list[int], packed: list[bytes], left: int | None = None) -> list[tuple[int, int]]:
    """Links between the components of a bucket, as many as it takes to join those that belong together.

    With ``left``, only the first ``left`` documents are compared with the others.
    The similarity of two documents is at most the share that either has in common with
    the other. Where all counts are 1 it follows from that share; else it is computed for the
    pairs that pass.
    """
    head = {r: r for r in roots}

    def find(r: int) -> int:
        while head[r] != r:
            head[r] = r = head[head[r]]
        return r

    sets = [unpack(p) for p in packed]
    sizes = np.array([len(p) for p, _ in sets])
    plain = all(c is None for _, c in sets)
    weights = np.concatenate([np.ones(len(p), np.float32) if c is None else c.astype(np.float32) for p, c in sets])
    docs, prints = np.repeat(np.arange(len(sets)), sizes), np.concatenate([p for p, _ in sets])
    total = np.bincount(docs, weights, len(sets))
    order = np.argsort(prints, kind="stable")
    ordered = prints[order]
    heads = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    # Only shingles that stand in several documents can be shared; their columns are numbered in order.
    shared = ~(heads & np.append(heads[1:], True))
    columns = np.cumsum(heads & shared)[shared] - 1
    docs, weights = docs[order][shared], weights[order][shared]
    label = np.unique(np.array(roots), return_inverse=True)[1]
    links = []
    cut = lambda start, stop: [range(a, min(a + LARGE_BUCKET, stop)) for a in range(start, stop, LARGE_BUCKET)]
    blocks = cut(0, len(sets) if left is None else left)
    for i, rows in enumerate(blocks):
        for others in blocks[i:] if left is None else cut(left, len(sets)):
            mass = _shared_mass(docs, columns, weights, rows, others)
            back = mass if plain else _shared_mass(docs, columns, weights, others, rows).T
            x, y = total[rows.start:rows.stop, None], total[None, others.start:others.stop]
            if plain:
                near = mass >= THRESHOLD * (x + y - mass) - 1e-6
            else:
                near = (mass >= THRESHOLD * x - 1e-6) & (back >= THRESHOLD * y - 1e-6)
            near &= label[rows.start:rows.stop, None] != label[None, others.start:others.stop]
            for a, b in np.argwhere(near).tolist():
                a, b = a + rows.start, b + others.start
                if a < b and find(roots[a]) != find(roots[b]) and similarity(packed[a], packed[b]) >= THRESHOLD - 1e-12:
                    links.append((nodes[a], nodes[b]))
                    head[find(roots[a])] = find(roots[b])
    return links


def _linked(rows: pa.Table) -> pa.Table:
    """Links of a task; rows of side 0 are compared with those of side 1, or with each other if there are none."""
    rows = rows.sort_by("side")
    left = rows.num_rows - int(rows.column("side").to_numpy().sum())
    found = links_within(*(rows.column(c).to_pylist() for c in ("node", "root", "shingles")),
                         left if left < rows.num_rows else None)
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def _blocks(n: str, share: float) -> F.Column:
    """Blocks for ``n`` nodes that are dealt by hash: three quarters full, so none holds more than ``share`` of a task."""
    return F.ceil(F.col(n) / F.lit(max(1.0, LARGE_BUCKET * share * 0.75))).cast("int")


def _dealt(blocks: F.Column) -> F.Column:
    return F.pmod(F.xxhash64("bucket", "node"), blocks).cast("int")


def _whole_tasks(open_: DataFrame) -> DataFrame:
    """``(bucket, task, side, node, root)``: small buckets whole, of large ones each block by itself."""
    task = F.when(F.col("n") <= LARGE_BUCKET, F.lit(0)).otherwise(_dealt(_blocks("n", 1.0)))
    return open_.select("bucket", task.cast("bigint").alias("task"), F.lit(0).alias("side"), "node", "root")


def _cross_tasks(open_: DataFrame) -> DataFrame:
    """``(bucket, task, side, node, root)``: every two blocks of a bucket, but not two of one component.

    A component that fills a block has its own blocks, named by its root; the small ones of a
    bucket share theirs, and those are also compared each with itself.
    """
    half = max(1.0, LARGE_BUCKET * 0.375)
    sizes = materialize(open_.groupBy("bucket", "root").agg(F.count("*").alias("size")))
    shared = sizes.filter(F.col("size") < half).groupBy("bucket").agg(F.sum("size").alias("rest"))
    own = sizes.filter(F.col("size") >= half)
    groups = materialize(
        own.select("bucket", F.lit(True).alias("own"), F.col("root").alias("name"), _blocks("size", 0.5).alias("blocks")).union(
            shared.select("bucket", F.lit(False), F.lit(0).cast("bigint"), _blocks("rest", 0.5))))
    names = {"own": "own_b", "name": "name_b", "blocks": "blocks_b"}
    before = F.struct("own", "name") < F.struct(F.col("own_b").alias("own"), F.col("name_b").alias("name"))
    itself = ~F.col("own") & ~F.col("own_b")
    pairs = (groups.join(groups.withColumnsRenamed(names), "bucket").filter(before | itself)
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("block_b", F.explode(F.sequence(F.lit(0), F.col("blocks_b") - 1)))
             .filter(~itself | (F.col("block") <= F.col("block_b"))))
    ends = F.array(F.struct(F.lit(0).alias("side"), "own", "name", "block"),
                   F.struct(F.lit(1).alias("side"), F.col("own_b").alias("own"), F.col("name_b").alias("name"),
                            F.col("block_b").alias("block")))
    alone = itself & (F.col("block") == F.col("block_b"))
    tasks = (pairs.select("bucket", F.xxhash64("own", "name", "block", "own_b", "name_b", "block_b").alias("task"),
                          F.explode(F.when(alone, F.slice(ends, 1, 1)).otherwise(ends)).alias("end"))
             .select("bucket", "task", "end.side", "end.own", "end.name", "end.block"))
    # The components' own blocks are found by (bucket, root), the shared ones by the bucket.
    known = groups.filter("own").select("bucket", F.col("name").alias("root"), F.col("blocks").alias("own_blocks"))
    several = groups.filter("NOT own").select("bucket", F.col("blocks").alias("shared_blocks"))
    members = lookup(open_.select("bucket", "node", "root").join(known, ["bucket", "root"], "left"), several, "bucket")
    large = F.col("own_blocks").isNotNull()
    members = members.select("bucket", "node", "root", large.alias("own"), F.when(large, F.col("root")).otherwise(F.lit(0)).alias("name"),
                             _dealt(F.coalesce("own_blocks", "shared_blocks")).alias("block"))
    return members.join(tasks, ["bucket", "own", "name", "block"]).select("bucket", "task", "side", "node", "root")


@dataclass(frozen=True)
class Described:
    """``rows``: ``(id, node, bands)`` of every document; ``clashes``: ``(node, least)`` of the hashes with several proofs, if any."""

    rows: DataFrame
    clashes: DataFrame | None
    bits: int

    def proved(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the columns ``node`` and ``proof``, the nodes of clashing documents numbered apart."""
        if self.clashes is None:
            return rows
        told = lookup(rows, self.clashes, "node")
        apart = F.col("least").isNotNull() & (F.col("proof") != F.col("least"))
        return told.withColumn("node", F.when(apart, F.xxhash64("node", "proof")).otherwise(F.col("node"))).drop("least")

    def with_nodes(self, docs: DataFrame, text: str, node: str) -> DataFrame:
        """``docs`` with the column ``node``, null without words."""
        hold = fresh("identity")
        wide = docs.withColumn(hold, _identities(self.bits)(quoted(text).cast("binary")))
        if self.clashes is None:
            return wide.withColumn(node, F.col(f"{hold}.node")).drop(hold)
        names = {c: fresh(f"c{i}") for i, c in enumerate(docs.columns)}  # so that none is called node or proof
        told = wide.select(*(quoted(c).alias(n) for c, n in names.items()), f"{hold}.node", f"{hold}.proof")
        return self.proved(told).select(*(F.col(n).alias(c) for c, n in names.items()), F.col("node").alias(node))


def describe(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = 64) -> Described:
    """What is needed of every document, written once."""
    read = docs.select(quoted(doc_id).cast("bigint").alias("id"), quoted(text).cast("binary").alias("text"))
    rows = materialize(read.mapInArrow(_described(bits), "id bigint, node bigint, proof bigint, bands array<bigint>"))
    proofs = rows.filter("node IS NOT NULL").groupBy("node").agg(F.min("proof").alias("least"), F.max("proof").alias("last"))
    clashes = materialize(proofs.filter("least <> last").select("node", "least"))
    if clashes.isEmpty():  # as good as always
        return Described(rows.drop("proof"), None, bits)
    told = Described(rows, clashes, bits)
    return Described(materialize(told.proved(rows).select("id", "node", "bands")), clashes, bits)


def _candidate_sets(buckets: DataFrame, described: Described, docs: DataFrame, text: str) -> DataFrame:
    """``(node, shingles)`` of every node that shares a bucket, from one of its texts."""
    wanted = materialize(buckets.select("node").distinct())
    few = wanted.count() * 8 <= MAX_SENT
    texts = (described.with_nodes(docs.select(quoted(text).cast("binary").alias("text")), "text", "node").select("node", "text")
             .join(F.broadcast(wanted) if few else wanted, "node", "left_semi")
             .groupBy("node").agg(F.first("text").alias("text")))
    return materialize(texts.mapInArrow(_packed, "node bigint, shingles binary"))


def near_roots(described: Described, docs: DataFrame, text: str = "text") -> DataFrame:
    """``(node, root)`` of every node that is linked to another."""
    nodes = described.rows.filter("node IS NOT NULL").groupBy("node").agg(F.first("bands").alias("bands"))
    exploded = nodes.select(F.explode("bands").alias("bucket"), "node")
    buckets = materialize(lookup(exploded, _several(exploded), "bucket", "inner"))
    sets = _candidate_sets(buckets, described, docs, text)
    roots = components(_verified(_first_pairs(buckets), sets))
    open_ = materialize(_open(buckets, roots))
    for tasks_of in (_whole_tasks, _cross_tasks):
        if open_.isEmpty():
            break
        members = tasks_of(open_).join(sets, "node").select("bucket", "task", "side", "node", "root", "shingles")
        links = materialize(members.groupBy("bucket", "task").applyInArrow(_linked, "a bigint, b bigint"))
        if not links.isEmpty():
            roots = components(roots.select(F.col("root").alias("a"), F.col("node").alias("b")).union(links))
        # Small buckets are finished; of a large one, pairs between its blocks are left.
        large = open_.filter(F.col("n") > LARGE_BUCKET)
        if large.isEmpty():
            break
        open_ = materialize(_open(large, roots))
    return roots


def near_classes(described: Described, docs: DataFrame, text: str = "text") -> DataFrame:
    """``(node, class_id, n_docs, keeper)`` of every node: its class is named by the smallest id in it,
    and ``keeper`` is the node that this id stands at."""
    roots = near_roots(described, docs, text)
    nodes = (described.rows.filter("node IS NOT NULL").groupBy("node")
             .agg(F.min("id").alias("least"), F.count("*").alias("n")))
    rooted = nodes.join(roots, "node", "left").select("node", "least", "n", F.coalesce("root", "node").alias("root"))
    rooted = materialize(rooted)
    order = F.struct(F.col("least").isNull().alias("no_id"), "least", "node")
    classes = rooted.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("n").alias("n_docs"),
                                         F.min(order).alias("first"))
    return (lookup(rooted.select("root", "node"), classes, "root", "inner")
            .select("node", "class_id", "n_docs", F.col("first.node").alias("keeper")))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = 64) -> DataFrame:
    """``(doc_id, class_id, n_docs)`` of every row of ``docs``, ids as longs; alone, a document is its own class."""
    described = describe(docs, doc_id, text, bits)
    rows = described.rows.select(F.col("id").alias("doc_id"), "node")
    joined = lookup(rows, near_classes(described, docs, text), "node")
    alone = F.col("node").isNull()
    return joined.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                         F.coalesce("n_docs", F.lit(1)).alias("n_docs"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = 64) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest id, of its repeated rows any.

    Rows of a node are combined map-side, so a third of all rows being copies of one text is
    no hot key. Rows without words are kept.
    """
    node, best = fresh("node"), fresh("best")
    described = describe(docs, doc_id, text, bits)
    keepers = near_classes(described, docs, text).filter("node = keeper").select(F.col("node").alias(node))
    rows = described.with_nodes(docs, text, node)
    whole = F.struct(*(quoted(c).alias(f"c{i}") for i, c in enumerate(docs.columns)))
    order = F.struct(quoted(doc_id).isNull().alias("no_id"), quoted(doc_id).alias("id"), quoted(text).alias("text"))
    firsts = rows.filter(F.col(node).isNotNull()).groupBy(node).agg(F.min_by(whole, order).alias(best))
    kept = firsts.join(keepers, node, "left_semi").select(
        *(F.col(f"{best}.c{i}").alias(c) for i, c in enumerate(docs.columns)))
    return kept.union(rows.filter(F.col(node).isNull()).select(*(quoted(c) for c in docs.columns)))


def op10_near_dups(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


QUERIES = {"op10_near_dups": op10_near_dups}
ORACLES: dict[str, str] = {}
