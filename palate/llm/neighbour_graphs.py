"""Approximate nearest neighbours by a navigable small-world graph for each shard.

Rows are dealt to shards by a hash of the row, so copies of one vector are spread evenly, and in a
shard equal vectors are one node that keeps its ``top + 1`` smallest ids, all that an answer can need.
A shard's nodes are numbered by level: every level keeps one node in ``SPREAD`` of the level below, drawn
by a hash, and level ``l`` consists of the first ``sizes[l]`` nodes. For every level there is one flat array
with ``degree`` neighbour numbers for each node, -1 where there are fewer. A node is linked as if
nodes were inserted in their order and each insertion found its true nearest predecessors: of those, the ones that
are nearer to it than to a neighbour chosen before; the links are then turned round and cut back
by the same rule. On the lowest level nodes that no path reaches get a link from the nearest node that one does.

The index is a table with one row for each shard, every kept row in one of them. Queries are dealt
to blocks; a task takes one shard and one block, goes down the levels greedily, searches the lowest with a
beam of ``beam`` nodes, and returns ``top`` rows of the shard for each query. The answers of
all shards are merged for each query. So work is queries times shards: larger shards (``shard_rows``) mean fewer of
them, at the price of building, which grows with the square of a shard, and memory.

Vectors that are null, empty, all zero, or hold a null or non-finite component take no part, nor do those with a
component beyond ``LARGEST`` in size, whose square leaves double precision. Vectors of different length are in different spaces. A row is no neighbour of itself, but its copies, same id or not,
are. A null id asks nothing and comes last among equals. Equal distances are ordered by id. Empty
tables give an empty result. Columns other than id and vector are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window

from palate.llm.common import quoted, table
from palate.llm.hashing import mixed
from palate.session import materialize

TOP = 10
#: Up to ``SHARDS`` shards hold about ``SHARD_ROWS`` rows each; beyond that they grow to ``MOST_ROWS``.
SHARD_ROWS, SHARDS, MOST_ROWS = 1 << 13, 64, 1 << 16
LARGEST = 1e150
#: Queries of a block.
BLOCK = 1 << 12
SPREAD = 16
#: Links of a node on the lowest level and on the others; predecessors and reversed links that are looked at.
DEGREE, UPPER_DEGREE, LOOKED_AT = 32, 16, 48
BEAM = 96
#: Queries that search together, and nodes that are linked together.
TOGETHER = 256


@dataclass
class Index:
    """``neighbours[l]`` holds ``degree`` numbers for each of the first ``sizes[l]`` nodes; level 0 has all."""

    vectors: np.ndarray
    sizes: list[int]
    neighbours: list[np.ndarray]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all of ``b``, good enough to choose candidates."""
    out = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None]
    out -= 2 * (a @ b.T)
    return np.maximum(out, 0.0, out=out)


def _predecessors(vectors: np.ndarray, most: int) -> np.ndarray:
    """The nearest nodes before each node, nearest first, -1 where there are none."""
    n = len(vectors)
    out = np.full((n, most), -1, np.int32)
    for at in range(0, n, TOGETHER):
        end = min(at + TOGETHER, n)
        away = _distances(vectors[at:end], vectors[:end])
        away[np.arange(end)[None] >= np.arange(at, end)[:, None]] = np.inf
        k = min(most, end)
        near = np.argpartition(away, k - 1, axis=1)[:, :k] if k < end else np.broadcast_to(np.arange(end), away.shape).copy()
        value = np.take_along_axis(away, near, 1)
        order = np.argsort(value, axis=1, kind="stable")
        near, value = np.take_along_axis(near, order, 1), np.take_along_axis(value, order, 1)
        out[at:end, :k] = np.where(np.isfinite(value), near, -1)
    return out


def _chosen(vectors: np.ndarray, nodes: np.ndarray, near: np.ndarray, degree: int) -> np.ndarray:
    """Of each node's candidates, nearest first: those nearer to it than to one chosen before, then the nearest others."""
    out = np.full((len(nodes), degree), -1, np.int32)
    for at in range(0, len(nodes), TOGETHER):
        here, ids = nodes[at:at + TOGETHER], near[at:at + TOGETHER]
        points = vectors[ids]
        own = vectors[here][:, None]
        away = ((points - own) ** 2).sum(-1)
        norms = (points ** 2).sum(-1)
        between = norms[:, :, None] + norms[:, None] - 2 * (points @ points.transpose(0, 2, 1))
        valid = ids >= 0
        picked = np.zeros(ids.shape, bool)
        cover = np.full(ids.shape, np.inf)
        for c in range(ids.shape[1]):
            take = valid[:, c] & (away[:, c] < cover[:, c]) & (picked.sum(1) < degree)
            picked[:, c] = take
            cover[take] = np.minimum(cover[take], between[take, c])
        # Chosen ones first, then the rest, each nearest first.
        order = np.argsort(np.where(picked, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :degree]
        kept = np.take_along_axis(np.where(valid, ids, -1), order, 1)
        out[at:at + TOGETHER, :kept.shape[1]] = kept
    return out


def _by_node(source: np.ndarray, target: np.ndarray, away: np.ndarray, n: int, most: int) -> np.ndarray:
    """A row for each source with its ``most`` nearest targets, nearest first, each once, -1 beyond."""
    order = np.lexsort((target, away, source))
    source, target = source[order], target[order]
    new = np.ones(len(source), bool)
    new[1:] = (source[1:] != source[:-1]) | (target[1:] != target[:-1])
    source, target = source[new], target[new]
    place = np.arange(len(source)) - np.searchsorted(source, source)
    kept = place < most
    out = np.full((n, most), -1, np.int32)
    out[source[kept], place[kept]] = target[kept]
    return out


def linked(vectors: np.ndarray, degree: int, looked_at: int = LOOKED_AT) -> np.ndarray:
    """The neighbour array of one level."""
    n = len(vectors)
    if n <= degree + 1:  # few enough for all to be neighbours
        others = np.array([[j for j in range(n) if j != i] for i in range(n)], np.int32).reshape(n, n - 1)
        return np.pad(others, ((0, 0), (0, degree - others.shape[1])), constant_values=-1)
    forward = _chosen(vectors, np.arange(n), _predecessors(vectors, min(looked_at, n)), degree // 2)
    source, place = np.nonzero(forward >= 0)
    target = forward[source, place]
    away = ((vectors[source] - vectors[target]) ** 2).sum(-1)
    both = _by_node(np.concatenate((source, target)), np.concatenate((target, source)), np.concatenate((away, away)), n, looked_at)
    return _connected(vectors, _chosen(vectors, np.arange(n), both, degree), forward[:, 0])


def _reached(neighbours: np.ndarray) -> np.ndarray:
    seen = np.zeros(len(neighbours), bool)
    seen[0], edge = True, np.array([0])
    while len(edge):
        found = np.unique(neighbours[edge])
        edge = found[(found >= 0) & ~seen[np.maximum(found, 0)]]
        seen[edge] = True
    return seen


def _connected(vectors: np.ndarray, neighbours: np.ndarray, nearest: np.ndarray) -> np.ndarray:
    """Every node reachable from the first: where one is not, its nearest predecessor gets a further link to it.

    By the order of insertion that makes all reachable. Rows grow by as many places as one needs.
    """
    lost = np.flatnonzero(~_reached(neighbours))
    if not len(lost):
        return neighbours
    source = nearest[lost]
    extra = _by_node(source, lost.astype(np.int32), np.zeros(len(lost)), len(neighbours), int(np.bincount(source).max()))
    return np.hstack((neighbours, extra))


def build(vectors: np.ndarray) -> Index:
    """The index of distinct vectors that are ordered by level already; ``sizes`` follow from their number."""
    sizes = [len(vectors)]
    while sizes[-1] > SPREAD * 4:
        sizes.append(math.ceil(sizes[-1] / SPREAD))
    return Index(vectors, sizes, [linked(vectors[:n], UPPER_DEGREE if level else DEGREE) for level, n in enumerate(sizes)])


def _greedy(index: Index, level: int, queries: np.ndarray, at: np.ndarray, away: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    active = np.arange(len(queries))
    while len(active):
        near = index.neighbours[level][at[active]]
        gaps = ((index.vectors[near] - queries[active][:, None]) ** 2).sum(-1)
        gaps[near < 0] = np.inf
        best = np.argmin(gaps, axis=1)
        value = gaps[np.arange(len(active)), best]
        better = value < away[active]
        at[active[better]], away[active[better]] = near[better, best[better]], value[better]
        active = active[better]
    return at, away


def search(index: Index, queries: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """``(nodes, squared distances)`` of the ``beam`` nearest nodes found for each query, nearest first; -1 beyond."""
    n, width = len(queries), min(beam, len(index.vectors))
    at = np.zeros(n, np.int64)
    away = ((index.vectors[0] - queries) ** 2).sum(-1)
    for level in range(len(index.sizes) - 1, 0, -1):
        at, away = _greedy(index, level, queries, at, away)
    nodes, gaps = np.full((n, width), -1, np.int64), np.full((n, width), np.inf)
    nodes[:, 0], gaps[:, 0] = at, away
    done = np.zeros((n, width), bool)
    seen = np.zeros((n, len(index.vectors)), bool)
    seen[np.arange(n), at] = True
    active = np.arange(n)
    while len(active):
        waiting = np.where(done[active] | (nodes[active] < 0), np.inf, gaps[active])
        place = np.argmin(waiting, axis=1)
        open_ = np.isfinite(waiting[np.arange(len(active)), place])
        active, place = active[open_], place[open_]
        if not len(active):
            break
        done[active, place] = True
        near = index.neighbours[0][nodes[active, place]].astype(np.int64)
        fresh = (near >= 0) & ~seen[active[:, None], np.maximum(near, 0)]
        seen[np.repeat(active, fresh.sum(1)), near[fresh]] = True
        value = np.full(near.shape, np.inf)
        row, column = np.nonzero(fresh)
        value[row, column] = ((index.vectors[near[row, column]] - queries[active[row]]) ** 2).sum(-1)
        every = np.hstack((gaps[active], value))
        order = np.argsort(every, axis=1, kind="stable")[:, :width]
        gaps[active] = np.take_along_axis(every, order, 1)
        nodes[active] = np.where(np.isfinite(gaps[active]), np.take_along_axis(np.hstack((nodes[active], near)), order, 1), -1)
        done[active] = np.take_along_axis(np.hstack((done[active], np.zeros(near.shape, bool))), order, 1)
    return nodes, gaps


# Shards as rows

_INDEXED = ("dim int, shard int, n_rows bigint, vectors binary, sizes binary, degrees binary, neighbours binary, "
            "starts binary, rows binary, ids binary, no_ids binary")


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return array.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _indexed(rows: pa.Table, top: int) -> pa.Table:
    """One row for a shard: the graph over its distinct vectors, and the smallest ids of each."""
    dim, shard = rows.column("dim")[0].as_py(), rows.column("shard")[0].as_py()
    vectors = _matrix(rows.column("vector"), dim) + 0.0  # -0.0 becomes 0.0
    no_id = rows.column("vec_id").is_null().to_numpy(zero_copy_only=False) if rows.num_rows else np.empty(0, bool)
    ids = rows.column("vec_id").fill_null(0).to_numpy()
    numbers = rows.column("row").to_numpy()
    whole = np.ascontiguousarray(vectors).view(np.dtype((np.void, 8 * dim))).ravel()
    _, first, node = np.unique(whole, return_index=True, return_inverse=True)
    distinct = vectors[first]
    # Levels are drawn by a hash of the vector, so they do not depend on the order of the rows.
    draw = mixed(np.bitwise_xor.reduce(mixed(distinct.view(np.uint64) + np.arange(dim, dtype=np.uint64)), axis=1))
    by_level = np.argsort(draw, kind="stable")
    place = np.empty(len(by_level), np.int64)
    place[by_level] = np.arange(len(by_level))
    node = place[node]
    index = build(distinct[by_level])
    order = np.lexsort((numbers, ids, no_id, node))
    node = node[order]
    kept = np.arange(len(node)) - np.searchsorted(node, node) <= top
    node, order = node[kept], order[kept]
    starts = np.searchsorted(node, np.arange(len(distinct) + 1))
    binary = lambda a, kind: pa.array([np.ascontiguousarray(a, kind).tobytes()], pa.binary())
    return pa.table({
        "dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int32()), "n_rows": pa.array([rows.num_rows], pa.int64()),
        "vectors": binary(index.vectors, np.float64), "sizes": binary(index.sizes, np.int64),
        "degrees": binary([x.shape[1] for x in index.neighbours], np.int64),
        "neighbours": binary(np.concatenate([x.ravel() for x in index.neighbours]), np.int32),
        "starts": binary(starts, np.int64), "rows": binary(numbers[order], np.int64), "ids": binary(ids[order], np.int64),
        "no_ids": binary(no_id[order], bool)})


def unpacked(row: dict) -> Index:
    """The index of a written shard."""
    vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, row["dim"])
    sizes, degrees = (np.frombuffer(row[c], np.int64).tolist() for c in ("sizes", "degrees"))
    flat, at, neighbours = np.frombuffer(row["neighbours"], np.int32), 0, []
    for size, degree in zip(sizes, degrees):
        neighbours.append(flat[at:at + size * degree].reshape(size, degree))
        at += size * degree
    return Index(vectors, sizes, neighbours)


def _answers(shard: dict, index: Index, rows: pa.Table, top: int, beam: int) -> Iterator[dict[str, np.ndarray]]:
    starts = np.frombuffer(shard["starts"], np.int64)
    member, ids = np.frombuffer(shard["rows"], np.int64), np.frombuffer(shard["ids"], np.int64)
    no_ids = np.frombuffer(shard["no_ids"], bool)
    asked, queries = rows.column("row").to_numpy(), _matrix(rows.column("vector"), shard["dim"])
    for at in range(0, len(asked), TOGETHER):
        nodes, gaps = search(index, queries[at:at + TOGETHER], beam)
        query, place = np.nonzero(nodes >= 0)
        node, gap = nodes[query, place], gaps[query, place]
        # Each found node stands for its rows.
        n = starts[node + 1] - starts[node]
        query, gap = np.repeat(query, n), np.repeat(gap, n)
        row = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[node], n)
        other = member[row] != asked[at:at + TOGETHER][query]
        query, gap, row = query[other], gap[other], row[other]
        order = np.lexsort((member[row], ids[row], no_ids[row], gap, query))
        query, gap, row = query[order], gap[order], row[order]
        kept = np.arange(len(query)) - np.searchsorted(query, query) < top
        query, gap, row = query[kept], gap[kept], row[kept]
        yield {"query": asked[at:at + TOGETHER][query], "row": member[row], "vec_id": ids[row], "no_id": no_ids[row], "score": np.sqrt(gap)}


def _searched(shards: pa.Table, queries: pa.Table, top: int, beam: int) -> pa.Table:
    """The best rows of one shard for the queries of one block."""
    kind = [("query", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]
    parts = []
    if shards.num_rows and queries.num_rows:
        shard = shards.to_pylist()[0]
        for found in _answers(shard, unpacked(shard), queries, top, beam):
            parts.append(pa.table([pa.array(found["query"], pa.int64()), pa.array(found["row"], pa.int64()),
                                   pa.array(found["vec_id"], pa.int64(), mask=found["no_id"]), pa.array(found["score"], pa.float64())],
                                  schema=pa.schema(kind)))
    return pa.concat_tables(parts) if parts else pa.schema(kind).empty_table()


def taking_part(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(row, vec_id, vector, dim)`` of the rows that take part, written once, so a row keeps its number."""
    value = quoted(vector)
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) <= LARGEST))
    some = F.exists(value, lambda x: x != 0)
    kept = rows.filter(F.when(value.isNull(), False).otherwise(finite) & some)
    return materialize(kept.select(F.monotonically_increasing_id().alias("row"), quoted(vec_id).cast("bigint").alias("vec_id"),
                                   value.alias("vector"), F.size(value).alias("dim")))


def shards_of(n_rows: int, shard_rows: int = SHARD_ROWS, shards: int = SHARDS, most_rows: int = MOST_ROWS) -> int:
    few = math.ceil(n_rows / shard_rows)
    return max(1, few if few <= shards else max(shards, math.ceil(n_rows / most_rows)))


def _dealt(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def build_index(rows: DataFrame, n_shards: int, top: int = TOP) -> DataFrame:
    """One row for each shard of ``taking_part`` rows, written once."""
    dealt = rows.withColumn("shard", _dealt(F.col("row"), n_shards))
    return materialize(dealt.groupBy("dim", "shard").applyInArrow(lambda t: _indexed(t, top), _INDEXED))


def nearest(rows: DataFrame, asks: Column, vec_id: str = "vec_id", vector: str = "embedding", top: int = TOP,
            beam: int = BEAM, shard_rows: int = SHARD_ROWS, block: int = BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the nearest rows of every row whose id satisfies ``asks``.

    ``asks`` is a condition on the column ``vec_id``; ``score`` is the Euclidean distance.
    """
    kept = taking_part(rows, vec_id, vector)
    n_shards = shards_of(kept.count(), shard_rows)
    index = build_index(kept, n_shards, top)
    queries = kept.filter(asks)
    blocks = max(1, math.ceil(queries.count() / block))
    asked = (queries.withColumn("block", _dealt(F.col("row"), blocks))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)))))
    offered = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ("dim", "shard", "block")
    found = (offered.groupBy(*keys).cogroup(asked.groupBy(*keys))
             .applyInArrow(lambda s, q: _searched(s, q, top, beam), "query bigint, row bigint, vec_id bigint, score double"))
    order = Window.partitionBy("query").orderBy("score", F.col("vec_id").asc_nulls_last(), "row")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(queries.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id")), "query").select(
        "query_id", "rank", "vec_id", "score")


def op13_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 nearest of all embeddings for every hundredth."""
    return nearest(table(spark, folder, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)


QUERIES = {"op13_nearest_vectors": op13_nearest_vectors}
ORACLES: dict[str, str] = {}
