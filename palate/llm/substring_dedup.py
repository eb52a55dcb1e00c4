"""Repeated passages removed: words under any window of 13 that an earlier document holds too.

Almost all windows occur once, so a count-min sketch finds out first which may not.
Documents are dealt to groups. Every group sketches its windows: a window hits one cell in each of two
rows, both in one small block, so a block number and two places in it say all. Sorted, these
take two to four bytes a window. They are cut into segments, and all groups' parts of a segment are added up in
one place, counting a group once a cell. Back goes, for each group, a bit for each of its entries: whether
others too have hit its cell in both rows. A sketch never counts too low, so a
window without that bit stands in no other group.

Second pass: the windows estimated repeated, and no others, are grouped exactly. A
group sends each of them once with its smallest document id, whatever the number of
its documents that hold it; the bucket finds the smallest of all and tells the groups
that come after. Repeats within a group need no message at all. So a passage shared
by a third of all documents costs one record for each group, not for each document.

All sizes follow from the bytes of text, see ``Layout``: the number of cells, so the share of windows that pass
by mistake stays the same; the number of groups, buckets and segments, so a task holds some tens of
megabytes whatever the number of shuffle partitions. Segments stop at ``MOST_SEGMENTS``, or a group would
send more rows than cells are worth; beyond some 256 GB of text a segment's part grows with the corpus instead (about
60 MB for each TB). Nothing is broadcast or collected. Windows are told apart by two independent 64-bit
fingerprints, 128 bits in all.

Null and empty texts have no words. Texts under 13 words lose none, texts of any length are read whole. A null id counts
as larger than any other; documents with equal ids do not take words from one another, so repeated rows keep
theirs. An empty table gives an empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from palate.llm.common import quoted, table
from palate.llm.hashing import distinct, fold, word_hashes

WINDOW = 13
#: Cells of a sketch row for each byte of text; a window takes some six bytes.
CELLS_PER_BYTE = 1.0
#: Cells of a block in either row, as bits; both places are told by one byte.
BLOCK_BITS = 4
#: Bytes of text for a group, for a segment of the sketch, and for a bucket of the exact grouping.
GROUP_BYTES, SEGMENT_BYTES, BUCKET_BYTES = 64 << 20, 64 << 20, 128 << 20
MOST_SEGMENTS = 1 << 12
GROUPS_PER_PARTITION = 2
BUCKETS_PER_PARTITION = 0.25
LAST = np.iinfo(np.int64).max
_RANDOM = np.random.default_rng(13)
_FACTORS = _RANDOM.integers(1, 2**63, (2, WINDOW), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLOCK_FACTOR, _PLACE_FACTOR = _RANDOM.integers(1, 2**63, 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass(frozen=True)
class Layout:
    """How the work is cut. An entry of the sketch has ``entry_bits`` bits: a block's number, then the two places."""

    groups: int
    entry_bits: int
    segment_bits: int
    bucket_bits: int

    @staticmethod
    def of(size: int, partitions: int) -> Layout:
        """For ``size`` bytes of text."""
        bits = lambda n: max(0, math.ceil(math.log2(max(1.0, n))))
        blocks = bits(max(1 << 16, size * CELLS_PER_BYTE)) - BLOCK_BITS
        segments = min(blocks, bits(min(MOST_SEGMENTS, max(partitions, size / SEGMENT_BYTES))))
        entry = blocks + 2 * BLOCK_BITS
        return Layout(max(GROUPS_PER_PARTITION * partitions, math.ceil(size / GROUP_BYTES)), entry, entry - segments,
                      bits(max(BUCKETS_PER_PARTITION * partitions, size / BUCKET_BYTES)))


class Group:
    """The windows of a group's documents, in ascending order of document id."""

    def __init__(self, rows: pa.Table):
        ids = [LAST if i is None else i for i in rows.column("id").to_pylist()]
        texts = rows.column("text").to_pylist()
        self.order = sorted(range(len(ids)), key=ids.__getitem__)
        self.texts = [texts[i] or b"" for i in self.order]
        self.ids = np.array([ids[i] for i in self.order], np.int64)
        self.hashes, self.sizes = word_hashes(self.texts)
        self.first_word = np.cumsum(self.sizes) - self.sizes
        # Windows over the joined texts, less those that run across an end.
        counts = np.maximum(self.sizes - WINDOW + 1, 0)
        self.doc = np.repeat(np.arange(len(counts)), counts)
        self.starts = np.arange(len(self.doc)) + np.repeat(self.first_word - (np.cumsum(counts) - counts), counts)

    def _fingerprints(self, factors: np.ndarray) -> np.ndarray:
        return fold(self.hashes, factors)[self.starts] if len(self.starts) else np.empty(0, np.uint64)

    @cached_property
    def prints(self) -> np.ndarray:
        return self._fingerprints(_FACTORS[0])

    @cached_property
    def second(self) -> np.ndarray:
        """Independent fingerprints; cells and buckets are chosen by them."""
        return self._fingerprints(_FACTORS[1])

    def entries(self, bits: int) -> np.ndarray:
        """Each window's block and its places in both rows of it, as one number of ``bits`` bits."""
        block = (self.second * _BLOCK_FACTOR) >> np.uint64(64 - bits + 2 * BLOCK_BITS)
        return (block << np.uint64(2 * BLOCK_BITS)) | ((self.second * _PLACE_FACTOR) >> np.uint64(64 - 2 * BLOCK_BITS))


def code_sorted(values: np.ndarray) -> bytes:
    """Ascending values: their low bytes as they are, what is above as gaps of variable length.

    So many low bytes are split off that a gap mostly fits one more byte, however far apart the values.
    """
    values = values.astype(np.uint64)
    n = len(values)
    spread = (int(values[-1]) - int(values[0])) / n if n else 1
    low = max(0, math.ceil((math.log2(max(1.0, spread)) - 6) / 8))
    lows = values[:, None].view(np.uint8).reshape(n, 8)[:, :low]
    gaps = np.diff(values >> np.uint64(8 * low), prepend=np.uint64(0))
    sizes = np.ones(n, np.int64)
    for k in range(1, 10):
        more = gaps >> np.uint64(7 * k) > 0 if 7 * k < 64 else np.zeros(n, bool)
        if not more.any():
            break
        sizes += more
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if n else 0, np.uint8)
    for k in range(int(sizes.max(initial=0))):
        own = sizes > k
        part = ((gaps[own] >> np.uint64(7 * k)) & np.uint64(0x7F)).astype(np.uint8)
        out[(ends - sizes)[own] + k] = part | ((sizes[own] > k + 1).astype(np.uint8) << 7)
    return bytes([low]) + n.to_bytes(8, "little") + lows.tobytes() + out.tobytes()


def decode_sorted(code: bytes) -> np.ndarray:
    low, n = code[0], int.from_bytes(code[1:9], "little")
    units = np.frombuffer(code, np.uint8, offset=9 + low * n)
    last = units < 0x80
    starts = np.concatenate(([0], np.flatnonzero(last)[:-1] + 1)) if n else np.empty(0, np.int64)
    place = np.arange(len(units)) - np.repeat(starts, np.diff(np.append(starts, len(units))))
    parts = (units & 0x7F).astype(np.uint64) << (np.uint64(7) * place.astype(np.uint64))
    values = np.cumsum(np.add.reduceat(parts, starts), dtype=np.uint64) << np.uint64(8 * low) if n else parts
    if low:
        lows = np.zeros((n, 8), np.uint8)
        lows[:, :low] = np.frombuffer(code, np.uint8, low * n, 9).reshape(n, low)
        values |= lows.view("<u8").ravel()
    return values


def slices(values: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(number, from, to) of the runs of ascending ``values`` that share what is above ``bits``."""
    if not len(values):
        return []
    high = (values >> np.uint64(bits)).astype(np.int64)
    edges = np.concatenate(([0], np.flatnonzero(high[1:] != high[:-1]) + 1, [len(high)]))
    return [(int(high[a]), int(a), int(z)) for a, z in zip(edges[:-1], edges[1:])]


def sketch_rows(rows: pa.Table, layout: Layout) -> pa.Table:
    """A group's sketch: its entries, by segment. Runs on one group."""
    number, own = rows.column("grp")[0].as_py(), distinct(Group(rows).entries(layout.entry_bits))
    out = [(high, code_sorted(own[a:z] - np.uint64(high << layout.segment_bits))) for high, a, z in slices(own, layout.segment_bits)]
    return pa.table({"segment": pa.array([s for s, _ in out], pa.int64()),
                     "grp": pa.array([number] * len(out), pa.int64()),
                     "entries": pa.array([c for _, c in out], pa.binary())})


def cells_of(entries: np.ndarray, row: int) -> np.ndarray:
    """The cell that each entry hits in one row."""
    place = entries >> np.uint64(BLOCK_BITS) if row == 0 else entries
    mask = np.uint64((1 << BLOCK_BITS) - 1)
    return ((entries >> np.uint64(2 * BLOCK_BITS)) << np.uint64(BLOCK_BITS)) | (place & mask)


def hit_by_several(groups: list[np.ndarray], cells: int) -> list[np.ndarray]:
    """For each group's cells, whether another group has hit them too. Dense where most cells are hit, else by sorting."""
    if sum(map(len, groups)) * 16 >= cells:
        counts = np.zeros(cells, np.uint8)
        for own in groups:
            counts[own] += counts[own] < 2  # a cell that stands here twice is raised once
        return [counts[own] > 1 for own in groups]
    ordered = np.sort(np.concatenate([distinct(own) for own in groups]))
    several = distinct(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(several):
        return [np.zeros(len(own), bool) for own in groups]
    return [several[np.minimum(np.searchsorted(several, own), len(several) - 1)] == own for own in groups]


def merge_sketches(rows: pa.Table, layout: Layout) -> pa.Table:
    """All groups' sketches of a segment added up; each group hears which entries others have hit in both rows."""
    entries = [decode_sorted(code.as_py()) for code in rows.column("entries")]
    cells = 1 << (layout.segment_bits - BLOCK_BITS)
    told = [np.ones(len(e), bool) for e in entries]
    for row in range(2):
        for own, hit in zip(told, hit_by_several([cells_of(e, row) for e in entries], cells)):
            own &= hit
    return pa.table({"segment": rows.column("segment"), "grp": rows.column("grp"),
                     "repeated": pa.array([np.packbits(t).tobytes() for t in told], pa.binary())})


def estimated_repeated(group: Group, masks: pa.Table, layout: Layout) -> np.ndarray:
    """The windows whose entries are hit by others too, by the answers of all segments."""
    told = dict(zip(masks.column("segment").to_pylist(), masks.column("repeated").to_pylist()))
    entries = group.entries(layout.entry_bits)
    own = distinct(entries)
    flags = [np.unpackbits(np.frombuffer(told[high], np.uint8), count=z - a) for high, a, z in slices(own, layout.segment_bits)]
    repeated = own[np.concatenate(flags).astype(bool)] if flags else own
    if not len(repeated):
        return np.empty(0, np.int64)
    return np.flatnonzero(repeated[np.minimum(np.searchsorted(repeated, entries), len(repeated) - 1)] == entries)


def ordered_runs(prints: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal pairs of fingerprints together, and where in it each new pair starts."""
    order = np.lexsort((second, prints))
    p, s = prints[order], second[order]
    heads = np.flatnonzero(np.concatenate(([True], (p[1:] != p[:-1]) | (s[1:] != s[:-1])))) if len(order) else order
    return order, heads


def smallest_ids(prints: np.ndarray, second: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each window the smallest id that stands at its like."""
    order, heads = ordered_runs(prints, second)
    out = np.empty(len(ids), np.int64)
    if len(ids):
        out[order] = np.repeat(np.minimum.reduceat(ids[order], heads), np.diff(np.append(heads, len(ids))))
    return out


def candidate_rows(rows: pa.Table, masks: pa.Table, layout: Layout) -> pa.Table:
    """Of a group, each window estimated repeated, once, with the smallest id that holds it."""
    out: list[tuple[int, bytes, bytes]] = []
    if rows.num_rows:
        group = Group(rows)
        passed = estimated_repeated(group, masks, layout)
        prints, second, ids = group.prints[passed], group.second[passed], group.ids[group.doc[passed]]
        order, heads = ordered_runs(prints, second)
        first = np.minimum.reduceat(ids[order], heads) if len(order) else ids
        prints, second = prints[order[heads]], second[order[heads]]
        bucket = second >> np.uint64(64 - layout.bucket_bits) if layout.bucket_bits else np.zeros(len(second), np.uint64)
        by_bucket = np.argsort(bucket, kind="stable")
        for high, a, z in slices(bucket[by_bucket], 0):
            here = by_bucket[a:z]
            out.append((high, np.stack((prints[here], second[here]), axis=1).astype("<u8").tobytes(), first[here].astype("<i8").tobytes()))
    number = rows.column("grp")[0].as_py() if rows.num_rows else 0
    return pa.table({"bucket": pa.array([o[0] for o in out], pa.int64()), "grp": pa.array([number] * len(out), pa.int64()),
                     "prints": pa.array([o[1] for o in out], pa.binary()), "firsts": pa.array([o[2] for o in out], pa.binary())})


def _pairs(codes: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(c.as_py(), "<u8").reshape(-1, 2) for c in codes]


def group_exactly(rows: pa.Table) -> pa.Table:
    """The smallest id of every window of a bucket; each group hears where another comes first."""
    prints = _pairs(rows.column("prints"))
    firsts = np.concatenate([np.frombuffer(f.as_py(), "<i8") for f in rows.column("firsts")])
    every = np.concatenate(prints)
    later = smallest_ids(every[:, 0], every[:, 1], firsts) < firsts
    ends = np.cumsum([len(p) for p in prints])
    told = [p[flags].tobytes() for p, flags in zip(prints, np.split(later, ends[:-1]))]
    return pa.table({"grp": rows.column("grp"), "later": pa.array(told, pa.binary())})


def found_in(prints: np.ndarray, second: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which windows are among the pairs of fingerprints ``known``."""
    out = np.zeros(len(prints), bool)
    if len(known) and len(prints):
        known = known[np.lexsort((known[:, 1], known[:, 0]))]
        at = np.searchsorted(known[:, 0], prints)
        heads = np.flatnonzero(np.concatenate(([True], known[1:, 0] != known[:-1, 0])))
        for k in range(int(np.diff(np.append(heads, len(known))).max())):  # once, but for equal first fingerprints
            spot = np.minimum(at + k, len(known) - 1)
            out |= (known[spot, 0] == prints) & (known[spot, 1] == second)
    return out


def remove(rows: pa.Table, answers: pa.Table) -> pa.Table:
    """A group's documents without the words under windows that stand in an earlier document."""
    group = Group(rows)
    ordered = np.sort(group.prints)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    gone = np.zeros(len(group.prints), bool)
    if len(twice):  # within the group
        spots = np.flatnonzero(twice[np.minimum(np.searchsorted(twice, group.prints), len(twice) - 1)] == group.prints)
        ids = group.ids[group.doc[spots]]
        gone[spots] = smallest_ids(group.prints[spots], group.second[spots], ids) < ids
    later = _pairs(answers.column("later"))
    if later:  # in other groups
        gone |= found_in(group.prints, group.second, np.concatenate(later))
    edges = np.zeros(len(group.hashes) + 1, np.int64)
    edges[group.starts[gone]] += 1  # starts are distinct, and so are the places after them
    edges[group.starts[gone] + WINDOW] -= 1
    covered = np.cumsum(edges) > 0
    kept, removed = [], []
    for first, size, text in zip(group.first_word.tolist(), group.sizes.tolist(), group.texts):
        under, words = covered[first:first + size], text.split()
        removed.append(int(under.sum()))
        kept.append(b" ".join(words if not removed[-1] else [w for w, u in zip(words, under.tolist()) if not u]).decode())
    ids = rows.column("id").to_pylist()
    return pa.table({"doc_id": pa.array([ids[i] for i in group.order], pa.int64()),
                     "n_words": pa.array(group.sizes, pa.int64()),
                     "n_removed": pa.array(removed, pa.int64()), "kept_text": pa.array(kept, pa.string())})


def dedup_substrings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_text)`` of every document.

    The documents are shuffled once, by group; the three steps that read them share
    that exchange.
    """
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length(quoted(text))), F.lit(0))).first()[0]
    layout = Layout.of(size, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keyed = docs.select(F.pmod(F.xxhash64(quoted(doc_id), quoted(text)), F.lit(layout.groups)).alias("grp"),
                        quoted(doc_id).cast("bigint").alias("id"), quoted(text).cast("binary").alias("text"))
    # Twice as many partitions as groups, so hardly a task gets more than a few; it takes one after the other.
    keyed = keyed.repartition(2 * layout.groups, "grp")
    sketches = keyed.groupBy("grp").applyInArrow(lambda rows: sketch_rows(rows, layout), "segment bigint, grp bigint, entries binary")
    masks = sketches.groupBy("segment").applyInArrow(
        lambda rows: merge_sketches(rows, layout), "segment bigint, grp bigint, repeated binary")
    candidates = keyed.groupBy("grp").cogroup(masks.groupBy("grp")).applyInArrow(
        lambda rows, told: candidate_rows(rows, told, layout), "bucket bigint, grp bigint, prints binary, firsts binary")
    answers = candidates.groupBy("bucket").applyInArrow(group_exactly, "grp bigint, later binary")
    return keyed.groupBy("grp").cogroup(answers.groupBy("grp")).applyInArrow(
        remove, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    deduped = dedup_substrings(table(spark, folder, "documents").select("doc_id", "text"))
    return deduped.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


QUERIES = {"op8_substring_dedup": op8_substring_dedup}
ORACLES = {"op8_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
n AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
s AS (SELECT doc_id, i, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS s,
             count(*) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS k FROM n),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first_id FROM s WHERE k = 13),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM f WHERE first_id < doc_id),
k AS (SELECT n.doc_id, count(c.i) AS n_removed, string_agg(word, ' ' ORDER BY n.i) FILTER (c.i IS NULL) AS kept
      FROM n LEFT JOIN c ON n.doc_id = c.doc_id AND n.i = c.i GROUP BY n.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)"""}
