"""The best documents for many queries at once, with sums that queries share computed once.

A query (an item of a benchmark) is a set of symbols, each a term with the times it stands in
the query. Term sets that several queries share are mined first: in rounds, pairs of symbols
that stand together in at least two queries become a new symbol, until no pair does. What comes
out is a graph: a node is the sum of two others, a query the sum of what is left of it. For a
batch of documents every term's contribution and then every node's is computed once, as
a row with a number for each document (the partial accumulators), and the queries add up
nodes instead of terms.

Two scans of the documents: one counts words, documents and the documents of each query term, the
other scores. Neither shuffles a document; a task sends a count for each term, and its ``top``
best documents for each query, which are merged by query, first in ``MERGERS`` slices.

Queries are dealt to groups of about ``MINED_CHARS`` characters, each mined in a task of its own.
Graphs are sent to all executors, so their size is checked: beyond ``MAX_CHARS`` characters of
query text the queries are dealt to several scans. No query is left out, and which pairs are mined
has no influence on a score.

Null and empty texts, and texts without a word, are no documents and have no terms; a query
without terms has no rows. Repeated documents are ranked each for itself, repeated queries get equal
rows. Equal scores are ordered by id, a null id last. Texts of any length are read whole. Empty
tables give an empty result. Columns other than id and text are not read, whatever their names.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from palate.llm.common import plain_words, quoted, table
from palate.session import materialize

TOP = 20
#: Characters of query text that one task mines, and that one scan may answer.
MINED_CHARS = 1 << 20
MAX_CHARS = 1 << 24
#: How many following symbols of a query a symbol may be paired with.
REACH = 8
#: Numbers that the accumulators of one batch of documents may hold.
CELLS = 1 << 21
MERGERS = 64
#: Bytes of text that are scored together.
BATCH_BYTES = 1 << 23
# Fixed values of the ranking.
SCALE, WEIGHT_SCALE, LENGTH_SHARE, LENGTH_FACTOR = 1_000_000_000, 1000, 25, 12


# Mining

@dataclass
class Graph:
    """Node ``n_leaves + i`` is the sum of ``left[i]`` and ``right[i]``, ``levels[i]`` steps above the terms.

    Leaf ``i`` is term ``terms[i]`` counted ``times[i]`` times; query ``q`` is the sum of the
    nodes ``parts[starts[q]:starts[q + 1]]``.
    """

    terms: np.ndarray
    times: np.ndarray
    left: np.ndarray
    right: np.ndarray
    levels: np.ndarray
    parts: np.ndarray
    starts: np.ndarray


def _ranked(query: np.ndarray, symbol: np.ndarray, often: np.ndarray) -> np.ndarray:
    """An order by query, in it the symbols that most queries share first."""
    return np.lexsort((symbol, -often[symbol], query))


def mine(query: np.ndarray, symbol: np.ndarray, n_symbols: int, reach: int = REACH) -> tuple[np.ndarray, ...]:
    """``(query, symbol, left, right)`` after all rounds; each ``(query, symbol)`` comes once.

    A round pairs symbols that lie within ``reach`` places of each other, best shared pair
    first, no symbol twice. The most shared pair of all is always taken wherever
    it stands, so every round makes progress and the last one finds no pair in two queries.
    """
    lefts: list[np.ndarray] = []
    rights: list[np.ndarray] = []
    total = n_symbols
    while len(symbol):
        often = np.bincount(symbol, minlength=total)
        order = _ranked(query, symbol, often)
        query, symbol = query[order], symbol[order]
        firsts, seconds = [], []
        for step in range(1, min(reach, len(symbol) - 1) + 1):
            at = np.flatnonzero((query[step:] == query[:-step]) & (often[symbol[step:]] > 1))
            firsts.append(at)
            seconds.append(at + step)
        a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (firsts, seconds))
        low, high = np.minimum(symbol[a], symbol[b]), np.maximum(symbol[a], symbol[b])
        kinds, kind, n = np.unique(low * total + high, return_inverse=True, return_counts=True)
        # Kinds numbered from the least to the most shared, ties by number.
        rank = np.empty(len(kinds), np.int64)
        rank[np.argsort(n, kind="stable")] = np.arange(1, len(kinds) + 1)
        value = np.where(n[kind] > 1, rank[kind], 0)
        best = np.zeros(len(symbol), np.int64)
        np.maximum.at(best, a, value)
        np.maximum.at(best, b, value)
        taken = (value > 0) & (best[a] == value) & (best[b] == value)
        a, b, kind = a[taken], b[taken], kind[taken]
        several = np.bincount(kind, minlength=len(kinds)) > 1
        a, b, kind = a[several[kind]], b[several[kind]], kind[several[kind]]
        if not len(a):
            break
        used, new = np.unique(kind, return_inverse=True)
        lefts.append(kinds[used] // total)
        rights.append(kinds[used] % total)
        symbol = symbol.copy()
        symbol[a] = total + new
        kept = np.ones(len(symbol), bool)
        kept[b] = False
        query, symbol, total = query[kept], symbol[kept], total + len(used)
    join = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
    return query, symbol, join(lefts), join(rights)


def graph_of(queries: list[list[bytes]], numbers: dict[bytes, int], reach: int = REACH) -> Graph:
    """The sharing graph of queries given as lists of words; ``numbers`` numbers the terms."""
    pairs = [np.unique(np.array([numbers[w] for w in words], np.int64), return_counts=True) for words in queries]
    sizes = [len(t) for t, _ in pairs]
    query = np.repeat(np.arange(len(queries)), sizes)
    term = np.concatenate([t for t, _ in pairs]) if sum(sizes) else np.empty(0, np.int64)
    times = np.concatenate([n for _, n in pairs]) if sum(sizes) else np.empty(0, np.int64)
    most = int(times.max(initial=0)) + 1
    leaves, symbol = np.unique(term * most + times, return_inverse=True)
    query, symbol, left, right = mine(query, symbol, len(leaves), reach)
    levels = np.zeros(len(leaves) + len(left), np.int32)
    for i, (x, y) in enumerate(zip(left.tolist(), right.tolist())):
        levels[len(leaves) + i] = max(levels[x], levels[y]) + 1
    order = np.argsort(query, kind="stable")
    starts = np.searchsorted(query[order], np.arange(len(queries) + 1))
    return Graph(leaves // most, leaves % most, left, right, levels[len(leaves):], symbol[order], starts)


_FIELDS = ("terms", "times", "left", "right", "levels", "parts", "starts")
_MINED = "first bigint, numbers binary, words binary, " + ", ".join(f"{f} binary" for f in _FIELDS)


def _mined(rows: pa.Table) -> pa.Table:
    """One row for a group of queries: its graph over the group's own words, and the queries' numbers."""
    texts = [t.as_py() for t in rows.column("text")]
    queries = [plain_words(t) for t in texts]
    words = sorted({w for q in queries for w in q})
    graph = graph_of(queries, {w: i for i, w in enumerate(words)})
    fields = {f: pa.array([np.asarray(getattr(graph, f), np.int64).tobytes()], pa.binary()) for f in _FIELDS}
    numbers = rows.column("query").to_numpy().astype(np.int64)
    return pa.table({"first": pa.array([int(numbers.min())], pa.int64()), "numbers": pa.array([numbers.tobytes()], pa.binary()),
                     "words": pa.array([b" ".join(words)], pa.binary()), **fields})


# Scans

def _sized(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[list[bytes]]]]:
    """``(ids, words of each text)`` of the rows that have words, some bytes of text at a time."""
    for batch in batches:
        ids, texts = batch.column("id"), batch.column("text")
        at = 0
        while at < len(texts):
            held: list[list[bytes]] = []
            places, size = [], 0
            while at < len(texts) and size < BATCH_BYTES:
                text = texts[at].as_py()
                size += len(text or b"")
                if words := plain_words(text):
                    held.append(words)
                    places.append(at)
                at += 1
            if held:
                yield ids.take(pa.array(places, pa.int64())), held


def _occurrences(held: list[list[bytes]], numbers: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(n_words of each text, text, term, times)`` of the words that are terms."""
    get = numbers.get
    lengths = np.array([len(words) for words in held], np.int64)
    hits = [[i for i in map(get, words) if i is not None] for words in held]
    place = np.repeat(np.arange(len(held)), [len(h) for h in hits])
    keys, times = np.unique(place * len(numbers) + np.array([i for h in hits for i in h], np.int64), return_counts=True)
    return lengths, keys // max(1, len(numbers)), keys % max(1, len(numbers)), times.astype(np.int64)


#: What a Python worker has built from a broadcast, by the broadcast's name.
_BUILT: dict[str, object] = {}


def _once(name: str, build):
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = build()
    return _BUILT[name]


def _counter(shared: Broadcast):
    """Per task: documents of each term, and as terms -1 and -2 the documents and words of all."""
    name = uuid.uuid4().hex

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _once(name, lambda: {w: i for i, w in enumerate(shared.value)})
        df, n_docs, n_words = np.zeros(len(numbers), np.int64), 0, 0
        for ids, held in _sized(batches):
            lengths, _, term, _ = _occurrences(held, numbers)
            df += np.bincount(term, minlength=len(numbers))
            n_docs, n_words = n_docs + len(held), n_words + int(lengths.sum())
        used = np.flatnonzero(df)
        if n_docs:
            yield pa.RecordBatch.from_pydict({
                "term": pa.array(np.concatenate((used, [-1, -2])), pa.int64()),
                "n": pa.array(np.concatenate((df[used], [n_docs, n_words])), pa.int64())})

    return counted


@dataclass
class Plan:
    """What scoring needs: terms, their weights, totals, and graphs whose terms are numbered alike."""

    words: list[bytes]
    weights: np.ndarray
    n_docs: int
    n_words: int
    graphs: list[tuple[np.ndarray, Graph]]


def accumulate(graph: Graph, terms: np.ndarray) -> np.ndarray:
    """Scores, a row for each query, from contributions, a row for each term; columns are documents."""
    n = len(graph.terms)
    nodes = np.empty((n + len(graph.left), terms.shape[1]), np.int64)
    np.multiply(terms[graph.terms], graph.times[:, None], out=nodes[:n])
    for level in range(1, int(graph.levels.max(initial=0)) + 1):
        at = np.flatnonzero(graph.levels == level)
        nodes[n + at] = nodes[graph.left[at]] + nodes[graph.right[at]]
    # A row of zeros ends the list, so that queries without parts add up nothing.
    picked = np.vstack((nodes[graph.parts], np.zeros((1, terms.shape[1]), np.int64)))
    scores = np.add.reduceat(picked, graph.starts[:-1], axis=0) if len(graph.starts) > 1 else picked[:0]
    scores[np.diff(graph.starts) == 0] = 0
    return scores


class Best:
    """The best documents so far of each query."""

    def __init__(self, n_queries: int, top: int):
        self.top, self.floor = top, np.zeros(n_queries, np.int64)
        self.held = [np.empty(0, np.int64) for _ in range(4)]  # query, score, no id, id
        self.waiting: list[list[np.ndarray]] = []
        self.size = 0

    def offer(self, scores: np.ndarray, no_id: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` has a row for each query; what is below a query's floor cannot be among its best."""
        query, doc = np.nonzero((scores > 0) & (scores >= self.floor[:, None]))
        self.waiting.append([query, scores[query, doc], no_id[doc], ids[doc]])
        self.size += len(query)
        if self.size > 4 * self.top * len(self.floor):
            self.settle()

    def settle(self) -> list[np.ndarray]:
        rows = [np.concatenate(column) for column in zip(self.held, *self.waiting)]
        order = np.lexsort((rows[3], rows[2], -rows[1], rows[0]))
        rows = [r[order] for r in rows]
        place = np.arange(len(order)) - np.searchsorted(rows[0], rows[0])
        self.held = [r[place < self.top] for r in rows]
        full = rows[0][place == self.top - 1]
        self.floor[full] = rows[1][place == self.top - 1]
        self.waiting, self.size = [], 0
        return self.held


def _scorer(shared: Broadcast, top: int):
    """Per task: the ``top`` best of its documents for each query."""
    name = uuid.uuid4().hex

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def build():
            return shared.value, {w: i for i, w in enumerate(shared.value.words)}

        plan, numbers = _once(name, build)
        best = [Best(len(queries), top) for queries, _ in plan.graphs]
        widest = max([len(numbers), *(len(g.terms) + len(g.left) + len(g.parts) for _, g in plan.graphs)])
        step = max(1, CELLS // max(1, widest))
        for ids, held in _sized(batches):
            lengths, place, term, times = _occurrences(held, numbers)
            # m of the ranking: 75 plus a quarter of the length against the mean, all in whole numbers.
            m = 100 - LENGTH_SHARE + (LENGTH_SHARE * lengths * plan.n_docs) // plan.n_words
            value = plan.weights[term] * ((SCALE * times) // (1000 * times + LENGTH_FACTOR * m[place]))
            no_id = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            numbers_of = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            edges = np.searchsorted(place, np.arange(0, len(held) + step, step))
            for k, first in enumerate(range(0, len(held), step)):
                here = slice(edges[k], edges[k + 1])
                docs = slice(first, first + step)
                terms = np.zeros((len(numbers), len(lengths[docs])), np.int64)
                terms[term[here], place[here] - first] = value[here]
                for own, (_, graph) in zip(best, plan.graphs):
                    own.offer(accumulate(graph, terms), no_id[docs], numbers_of[docs])
        for own, (queries, _) in zip(best, plan.graphs):
            query, score, no_id, ids = own.settle()
            if len(query):
                yield pa.RecordBatch.from_pydict({
                    "query": pa.array(queries[query], pa.int64()), "score": pa.array(score, pa.int64()),
                    "doc_id": pa.array(ids, pa.int64(), mask=no_id.astype(bool))})

    return scored


def _ints(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64)


def _weights(df: dict[int, int], n_terms: int, n_docs: int) -> np.ndarray:
    out = [math.floor(WEIGHT_SCALE * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1))) for i in range(n_terms)]
    return np.array(out, np.int64)


def _scan(rows: DataFrame, mined: list, top: int) -> DataFrame | None:
    """``(query, score, doc_id)``, at most ``top`` a task and query, for the mined groups."""
    spark = rows.sparkSession
    words = sorted({w for row in mined for w in bytes(row["words"]).split()})
    if not words:
        return None
    counts = (rows.mapInArrow(_counter(spark.sparkContext.broadcast(words)), "term bigint, n bigint")
              .groupBy("term").agg(F.sum("n").alias("n")).collect())  # a row for each query term
    found = {row["term"]: row["n"] for row in counts}
    if -1 not in found:
        return None
    number = {w: i for i, w in enumerate(words)}
    graphs = []
    for row in mined:
        graph = Graph(*(_ints(bytes(row[f])) for f in _FIELDS))
        own = np.array([number[w] for w in bytes(row["words"]).split()], np.int64)
        graph.terms = own[graph.terms] if len(graph.terms) else graph.terms
        graphs.append((_ints(bytes(row["numbers"])), graph))
    plan = Plan(words, _weights(found, len(words), found[-1]), found[-1], found[-2], graphs)
    return rows.mapInArrow(_scorer(spark.sparkContext.broadcast(plan), top), "query bigint, score bigint, doc_id bigint")


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", top: int = TOP, mined_chars: int = MINED_CHARS, max_chars: int = MAX_CHARS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` documents of every item, best first.

    ``doc_id`` must fit a long; ``item_id`` keeps its type.
    """
    spark = docs.sparkSession
    rows = docs.select(quoted(doc_id).cast("bigint").alias("id"), quoted(text).cast("binary").alias("text"))
    asked = materialize(items.select(F.monotonically_increasing_id().alias("query"), quoted(item_id).alias("item_id"),
                                     quoted(item_text).cast("binary").alias("text")))
    chars = asked.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    groups, scans = max(1, math.ceil(chars / mined_chars)), max(1, math.ceil(chars / max_chars))
    group = F.pmod(F.xxhash64("query"), F.lit(groups)).cast("int")
    mined = materialize(asked.withColumn("group", group).groupBy("group")
                        .applyInArrow(lambda t: _mined(t.drop_columns(["group"])), _MINED))
    best = None
    for scan in range(scans):
        graphs = mined.filter(F.pmod(F.xxhash64("first"), F.lit(scans)) == scan).collect()  # by groups of a known size
        found = _scan(rows, graphs, top)
        if found is not None:
            best = found if best is None else best.union(found)
    if best is None:
        best = spark.createDataFrame([], "query bigint, score bigint, doc_id bigint")
    order = (F.desc("score"), F.col("doc_id").asc_nulls_last())
    slices = best.withColumn("slice", F.pmod(F.spark_partition_id(), F.lit(MERGERS)))
    for keys in (["query", "slice"], ["query"]):
        slices = slices.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= top)
    return slices.join(asked.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best of all documents for every item of the benchmark."""
    return search(table(spark, folder, "documents").select("doc_id", "text"),
                  table(spark, folder, "benchmark").select("item_id", "text"))


QUERIES = {"op11_ranked_search": op11_ranked_search}
ORACLES = {"op11_ranked_search": r"""
WITH dw AS (SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
d AS (SELECT r, doc_id, len(w)::BIGINT AS n, w FROM dw WHERE len(w) > 0),
totals AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM d),
bw AS (SELECT row_number() OVER () AS q, item_id,
              regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
qt AS (SELECT q, item_id, t, count(*)::BIGINT AS times FROM (SELECT q, item_id, unnest(w) AS t FROM bw) GROUP BY ALL),
occ AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t),
df AS (SELECT t, count(*)::BIGINT AS df FROM occ WHERE t IN (SELECT t FROM qt) GROUP BY t),
wt AS (SELECT t, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS weight FROM df, totals),
c AS (SELECT occ.r, occ.t, weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll))) AS v
      FROM occ JOIN wt USING (t) JOIN d USING (r), totals),
s AS (SELECT q, item_id, r, sum(times * v)::BIGINT AS score FROM qt JOIN c USING (t) GROUP BY q, item_id, r HAVING sum(times * v) > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank
      FROM s JOIN d USING (r)) WHERE rank <= 20"""}
