"""Clusters of whole-number vectors around centroids, exactly, by rounds of assigning and averaging.

Each round the centroids are built into a vantage-point tree, which is broadcast. A node holds one
centroid and splits the others by their distance to it into a near and a far half; a leaf holds a
few. Every vector searches the tree by best first: of the parts it has not entered it takes the one with the
least possible distance (from the triangle inequality and the range of distances in the part), until
that exceeds the distance of the nearest centroid so far. Parts at exactly that distance are entered too, with
some slack for rounding, so equal distances are all met, and the smaller number wins. Distances to
centroids are sums of whole numbers, without rounding. A batch of vectors takes its steps together,
each with a queue of its own.

A task sends one row for each cluster: its count and componentwise sums. No vector is shuffled, so
a cluster with a third of all rows is no hot key. The centroids, a row for each cluster, are all
that reaches the driver; ``k`` is bounded by ``MAX_CENTROIDS``.

Kept are vectors of ``dims`` components, none null or non-finite. Components become floor(scale * x);
a vector with one beyond ``LIMIT`` in size takes no part either, since its squared distances
may not fit 64 bits. A null id stands as an empty one where the first centroids are drawn. Repeated rows
count as often as they come; equal centroids stay apart, the smaller number gets the vectors. With fewer than ``k`` vectors
there are as many centroids; without any the result is empty. Columns other than id and vector are not
read, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from palate.llm.common import quoted, table
from palate.session import materialize

K, ROUNDS, DIMS, SCALE, SEED = 8, 10, 64, 1024, 3
MAX_CENTROIDS = 1 << 12
LIMIT = 1 << 27
#: Centroids in a leaf of the tree.
LEAF = 2
#: Vectors that search together.
TOGETHER = 2048


@dataclass
class Tree:
    """Node ``i``: ``own[i]`` centroids from ``first[i]`` in ``order`` on; ``children[i]`` are -1 in a leaf.

    ``nearest[i, s]`` and ``furthest[i, s]`` bound the distances between the node's first centroid, its
    vantage point, and the centroids of its child ``s``.
    """

    centroids: np.ndarray
    order: np.ndarray
    first: np.ndarray
    own: np.ndarray
    children: np.ndarray
    nearest: np.ndarray
    furthest: np.ndarray


def squared(points: np.ndarray, point: np.ndarray) -> np.ndarray:
    gap = points - point
    return np.einsum("...i,...i->...", gap, gap)


def build(centroids: np.ndarray, leaf: int = LEAF) -> Tree:
    """The tree; the vantage point is the centroid furthest from the first, the halves meet at the median."""
    order: list[int] = []
    nodes: list[list] = []

    def add(members: np.ndarray) -> int:
        at = len(nodes)
        if len(members) <= leaf:
            nodes.append([len(order), len(members), (-1, -1), (0.0, 0.0), (0.0, 0.0)])
            order.extend(members.tolist())
            return at
        vantage = members[int(np.argmax(squared(centroids[members], centroids[members[0]])))]
        rest = members[members != vantage]
        nodes.append([len(order), 1, None, None, None])
        order.append(int(vantage))
        away = np.sqrt(squared(centroids[rest], centroids[vantage]).astype(np.float64))
        ranked = np.argsort(away, kind="stable")
        halves = ranked[:(len(rest) + 1) // 2], ranked[(len(rest) + 1) // 2:]
        nodes[at][2] = tuple(add(rest[np.sort(h)]) if len(h) else -1 for h in halves)
        nodes[at][3] = tuple(float(away[h].min()) if len(h) else 0.0 for h in halves)
        nodes[at][4] = tuple(float(away[h].max()) if len(h) else 0.0 for h in halves)
        return at

    add(np.arange(len(centroids)))
    first, own, children, nearest, furthest = (np.array(c) for c in zip(*nodes))
    return Tree(centroids, np.array(order), first, own, children, nearest, furthest)


def search(tree: Tree, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(number, squared distance)`` of the nearest centroid of each vector, the smaller number of equals."""
    n, far = len(vectors), np.iinfo(np.int64).max
    number, distance = np.full(n, len(tree.centroids)), np.full(n, far)
    bounds = np.full((n, len(tree.first)), np.inf)
    bounds[:, 0] = 0.0
    active = np.arange(n)
    while len(active):
        queue = bounds[active]
        node = np.argmin(queue, axis=1)
        least = queue[np.arange(len(active)), node]
        limit = np.sqrt(distance[active].astype(np.float64))
        # Inclusive: a part at the very distance may hold an equal centroid with a smaller number.
        open_ = np.isfinite(least) & (least <= limit + 1e-9 * (limit + least) + 1e-6)
        active, node = active[open_], node[open_]
        bounds[active, node] = np.inf
        for at in np.unique(node).tolist():
            here = active[node == at]
            for place in range(tree.first[at], tree.first[at] + tree.own[at]):
                centroid = tree.order[place]
                gap = squared(vectors[here], tree.centroids[centroid])
                if place == tree.first[at]:
                    away = np.sqrt(gap.astype(np.float64))
                better = (gap < distance[here]) | ((gap == distance[here]) & (centroid < number[here]))
                distance[here[better]], number[here[better]] = gap[better], centroid
            for side, child in enumerate(tree.children[at].tolist()):
                if child >= 0:
                    bounds[here, child] = np.maximum(0.0, np.maximum(tree.nearest[at, side] - away, away - tree.furthest[at, side]))
    return number, distance


def _whole(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


#: The tree that a Python worker searches, by its broadcast's name.
_TREE: dict[str, Tree] = {}


def _assigner(shared: Broadcast, dims: int):
    """``(id or whole vectors, numbers, distances)`` of every ``TOGETHER`` rows."""
    name = uuid.uuid4().hex

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
        if name not in _TREE:
            _TREE.clear()
            _TREE[name] = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                vectors = _whole(part, dims)
                yield part, vectors, *search(_TREE[name], vectors)

    return assigned


def _summed(shared: Broadcast, dims: int):
    assigned = _assigner(shared, dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(shared.value.centroids)
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for _, vectors, number, _ in assigned(batches):
            counts += np.bincount(number, minlength=k)
            order = np.argsort(number, kind="stable")
            used, at = np.unique(number[order], return_index=True)
            sums[used] += np.add.reduceat(vectors[order], at, axis=0)
        used = np.flatnonzero(counts)
        if len(used):
            yield pa.RecordBatch.from_pydict({"cluster": pa.array(used, pa.int32()), "n": pa.array(counts[used], pa.int64()),
                                              "sums": pa.array(list(sums[used]), pa.list_(pa.int64()))})

    return run


def _placed(shared: Broadcast, dims: int):
    assigned = _assigner(shared, dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, number, distance in assigned(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), pa.array(number, pa.int32()), pa.array(distance, pa.int64())],
                names=["vec_id", "cluster", "distance"])

    return run


def whole_vectors(rows: DataFrame, vec_id: str, vector: str, dims: int, scale: int) -> DataFrame:
    """``(vec_id, vector)`` of the kept rows, components as whole numbers."""
    value = quoted(vector)
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < float(LIMIT)))
    # The size comes first: forall is true of an empty vector.
    kept = rows.filter(F.when(value.isNull() | (F.size(value) != dims), False).otherwise(finite))
    return kept.select(quoted(vec_id).alias("vec_id"),
                       F.transform(value, lambda x: F.floor(x.cast("double") * scale).cast("bigint")).alias("vector"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors whose ids have the smallest digests; equal ids are ordered by their vectors."""
    digest: Column = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.orderBy(digest, "vector").limit(k).select("vector").collect()
    return np.array([r["vector"] for r in rows], np.int64)


def next_centroids(centroids: np.ndarray, sums: DataFrame) -> np.ndarray:
    """Exact floors of the means; a cluster without vectors keeps its centroid."""
    parts = sums.select("cluster", "n", F.posexplode("sums").alias("at", "part"))
    totals = parts.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    out = centroids.copy()
    for cluster, at, n, total in totals.collect():  # a row for each component of a centroid
        out[cluster, at] = int(total) // n
    return out


def cluster(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = K, rounds: int = ROUNDS,
            dims: int = DIMS, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of every kept vector."""
    if k > MAX_CENTROIDS:
        raise ValueError(f"at most {MAX_CENTROIDS} centroids")
    spark = rows.sparkSession
    vectors = whole_vectors(rows, vec_id, vector, dims, scale)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        return vectors.limit(0).select("vec_id", *(F.lit(None).cast(t).alias(c) for c, t in (
            ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"), ("inertia", "bigint"),
            ("centroid_sha256", "string"))))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(build(centroids))
        sums = vectors.select("vector").mapInArrow(_summed(shared, dims), "cluster int, n bigint, sums array<bigint>")
        centroids = next_centroids(centroids, sums)
        shared.destroy()
    shared = spark.sparkContext.broadcast(build(centroids))
    placed = materialize(vectors.mapInArrow(_placed(shared, dims), f"vec_id {kind}, cluster int, distance bigint"))
    inertia = {r["cluster"]: int(r["d"]) for r in placed.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}  # a row for each centroid
    fits = lambda n: n if n < 1 << 63 else None
    facts = [(c, fits(d), fits(sum(inertia.values())), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
             for c, d in inertia.items()]
    known = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return placed.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """All embeddings in 8 clusters after 10 rounds."""
    return cluster(table(spark, folder, "embeddings").select("vec_id", "embedding"))


def _oracle() -> str:
    parts = [f"""
kept AS (SELECT row_number() OVER () AS r, vec_id, [floor(x::DOUBLE * {SCALE})::BIGINT FOR x IN embedding] AS q FROM embeddings
         WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = {DIMS}),
v AS MATERIALIZED (SELECT r, i, q[i] AS x FROM (SELECT r, q, unnest(range(1, {DIMS + 1})) AS i FROM kept)),
c0 AS MATERIALIZED (SELECT c, i, q[i] AS y FROM (SELECT c, q, unnest(range(1, {DIMS + 1})) AS i FROM (
        SELECT q, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), q) - 1 AS c FROM kept) WHERE c < {K}))"""]
    for k in range(ROUNDS + 1):
        parts.append(f"""
a{k} AS MATERIALIZED (SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
        SELECT r, c, sum((x - y) * (x - y))::BIGINT AS d FROM v JOIN c{k} USING (i) GROUP BY r, c) GROUP BY r)""")
        if k < ROUNDS:
            parts.append(f"""
m{k} AS (SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM v JOIN a{k} USING (r) GROUP BY c, i),
c{k + 1} AS MATERIALIZED (SELECT c, i, coalesce((s - ((s % n) + n) % n) // n, y) AS y FROM c{k} LEFT JOIN m{k} USING (c, i))""")
    return "WITH" + ",".join(parts) + f""",
digest AS (SELECT c, sha256(string_agg(y::VARCHAR, ',' ORDER BY i)) AS h FROM c{ROUNDS} GROUP BY c)
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, h AS centroid_sha256
FROM a{ROUNDS} JOIN kept USING (r) JOIN digest USING (c)"""


QUERIES = {"op12_centroid_clusters": op12_centroid_clusters}
ORACLES = {"op12_centroid_clusters": _oracle()}
