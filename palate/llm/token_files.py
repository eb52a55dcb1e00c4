"""Token ids written as shards that a Re-Pair grammar compresses, readable at any token.

Documents are range-partitioned and sorted by id, tokenised, and cut into shards of
some million tokens. In each shard the most frequent pairs of neighbouring symbols are
replaced by new symbols, over and over, until no pair stands ``MIN_COUNT`` times; what is
left is a short sequence and a list of rules. The expanded length of every rule is stored, so a reader finds the symbol
that holds token ``i`` by a search in running lengths and expands only what it needs.

A shard is one binary block (``pack``), and the blocks are rows of a Parquet table in
order (``part``, ``shard``). Spark's writer commits them, so a lost executor's shards
are simply written again, and any store that Spark writes to will do.

Null and empty texts hold only the end id. Null ids come first; rows with equal ids
are ordered by a hash of the text, so reruns agree. An empty table writes no shards.
Other columns are not read.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from palate.llm.common import quoted, table
from palate.llm.hashing import located_words, word_hashes
from palate.session import scratch_path

END_ID = 2
SHARD_TOKENS = 1 << 22
MIN_COUNT = 8
#: Pairs that the first rounds replace at once; later rounds take half of what stands often enough, if that is more.
ROUND_PAIRS = 1 << 12
MAGIC = b"RPR2"
_HEADER = struct.Struct("<4sIQIIQ")  # magic, documents, tokens, first rule symbol, rules, symbols
BLOCKS = "part int, shard int, n_docs bigint, n_tokens bigint, block binary"


@dataclass
class Shard:
    """``left[k]``, ``right[k]`` are what symbol ``base + k`` stands for, ``lengths[k]`` its tokens."""

    base: int
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray
    ids: list[int | None]
    sizes: np.ndarray

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """All symbols replaced by their tokens, each written at its place; about two steps a token, however deep."""
        work = symbols.astype(np.uint32)
        sizes = self.lengths_of(work)
        places = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), np.uint32)
        while len(work):
            nested = work >= self.base
            out[places[~nested]] = work[~nested]
            rules, places = work[nested] - np.uint32(self.base), places[nested]
            left = self.left[rules]
            work = np.concatenate((left, self.right[rules]))
            places = np.concatenate((places, places + self.lengths_of(left)))
        return out

    def lengths_of(self, symbols: np.ndarray) -> np.ndarray:
        lengths = np.ones(len(symbols), np.int64)
        nested = symbols >= self.base
        lengths[nested] = self.lengths[symbols[nested] - np.uint32(self.base)]
        return lengths

    def symbol_lengths(self) -> np.ndarray:
        return self.lengths_of(self.symbols)

    def tokens(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Tokens ``start`` to ``stop``, expanding only the symbols that hold them."""
        ends = np.cumsum(self.symbol_lengths())
        stop = (int(ends[-1]) if len(ends) else 0) if stop is None else stop
        if stop <= start:
            return np.empty(0, np.uint32)
        first, last = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left")
        skipped = int(ends[first - 1]) if first else 0
        return self.expand(self.symbols[first:last + 1])[start - skipped:stop - skipped]


def slots(keys: np.ndarray) -> np.ndarray:
    """Pairs by the top 20 bits of a product."""
    wide = keys.dtype == np.uint64
    factor, shift = keys.dtype.type(0x9E3779B97F4A7C15 if wide else 0x9E3779B1), keys.dtype.type(44 if wide else 12)
    return keys * factor >> shift


def frequent_pairs(keys: np.ndarray, least: int) -> np.ndarray:
    """The pairs that stand at least ``least`` times, the most frequent first."""
    ordered = np.sort(keys)
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    counts = np.diff(np.append(starts, len(ordered)))
    often = np.flatnonzero(counts >= least)
    return ordered[starts[often[np.argsort(-counts[often], kind="stable")]]]


def places_of(keys: np.ndarray, at: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places ``at`` where a pair ``chosen[k]`` is replaced, from left to right without overlap, and the ``k`` of each."""
    # The last in a slot wins; others wait for the next round, and there always is one while a pair stands often enough.
    rule = np.zeros(1 << 20, np.uint32)
    rule[slots(chosen)] = np.arange(1, len(chosen) + 1)
    found = rule[slots(keys)]
    spots = np.flatnonzero(found)
    found = found[spots] - 1
    same = chosen[found] == keys[spots]
    spots, found = at[spots[same]], found[same]
    # Within a run of neighbouring spots every second one is taken.
    runs = np.flatnonzero(np.concatenate(([True], spots[1:] != spots[:-1] + 1)))
    offset = np.arange(len(spots)) - np.repeat(runs, np.diff(np.append(runs, len(spots))))
    taken = offset & 1 == 0
    return spots[taken], found[taken]


def compress(tokens: np.ndarray, ids: list[int | None], sizes: np.ndarray, least: int = MIN_COUNT) -> Shard:
    """Re-Pair in rounds: each replaces the most frequent pairs of the sequence so far at once.

    It ends when no pair stands ``least`` times. A pair that does not can only get rarer, as a new
    pair always has a new symbol; so later rounds look only at pairs that were often enough and at
    those beside a replaced one. Symbols take two bytes while 2**16 are enough, then four.
    """
    base = int(tokens.max(initial=0)) + 1
    symbols = tokens.astype(np.uint16 if base < 1 << 16 else np.uint32)
    left, right, lengths = [], [], np.ones(base, np.uint32)
    alive = np.ones(max(len(symbols) - 1, 0), bool)
    while True:
        at = np.flatnonzero(alive)
        if len(at) < least:
            break
        bits = 8 * symbols.dtype.itemsize
        keys = symbols[at].astype(np.uint32 if bits == 16 else np.uint64)
        keys <<= keys.dtype.type(bits)
        keys |= symbols[at + 1]
        often = frequent_pairs(keys, least)
        if not len(often):
            break
        chosen = often[:max(ROUND_PAIRS, len(often) // 2)]
        spots, found = places_of(keys, at, chosen)
        # Only rules that are used are kept.
        used = np.bincount(found, minlength=len(chosen)) > 0
        first, chosen, found = len(lengths), chosen[used], (np.cumsum(used) - 1)[found]
        a, b = (chosen >> chosen.dtype.type(bits)).astype(np.uint32), (chosen & chosen.dtype.type((1 << bits) - 1)).astype(np.uint32)
        left.append(a)
        right.append(b)
        lengths = np.concatenate((lengths, lengths[a] + lengths[b]))
        hopeful = np.zeros(1 << 20, bool)
        hopeful[slots(often)] = True
        alive[at] = hopeful[slots(keys)]
        if len(lengths) > 1 << 16 and bits == 16:
            symbols = symbols.astype(np.uint32)
        kept = np.ones(len(symbols), bool)
        kept[spots + 1] = False
        symbols[spots] = first + found
        symbols = symbols[kept]
        new = spots - np.arange(len(spots))  # where the replaced pairs now are
        alive = np.append(alive, False)[kept]
        alive[new] = True
        alive[new[new > 0] - 1] = True
        alive = alive[:-1]
    rules = [np.concatenate([np.empty(0, np.uint32), *x]) for x in (left, right)]
    return Shard(base, *rules, lengths[base:], symbols, ids, sizes)


def pack(shard: Shard) -> bytes:
    """Header, rules, expanded lengths, document ids (with a mask of nulls) and sizes, the symbols' low 16 bits, and
    each higher bit that occurs as a row of bits."""
    ids = np.array([i or 0 for i in shard.ids], "<i8")
    nulls = np.array([i is None for i in shard.ids], np.uint8)
    head = _HEADER.pack(MAGIC, len(ids), int(shard.sizes.sum()), shard.base, len(shard.left), len(shard.symbols))
    width = max(16, (shard.base + len(shard.left) - 1).bit_length())
    high = [np.packbits(shard.symbols >> np.uint32(bit) & 1).tobytes() for bit in range(16, width)]
    return b"".join((head, struct.pack("<I", width), *(x.astype("<u4").tobytes() for x in (
        shard.left, shard.right, shard.lengths)), ids.tobytes(), nulls.tobytes(),
        shard.sizes.astype("<u8").tobytes(), shard.symbols.astype("<u2").tobytes(), *high))


def unpack(block: bytes) -> Shard:
    magic, n_docs, _, base, n_rules, n_symbols = _HEADER.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a shard of token ids")
    (width,), at = struct.unpack_from("<I", block, _HEADER.size), _HEADER.size + 4

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        values = np.frombuffer(block, kind, count, at)
        at += values.nbytes
        return values

    left, right, lengths = (take("<u4", n_rules) for _ in range(3))
    ids, nulls, sizes = take("<i8", n_docs), take("u1", n_docs), take("<u8", n_docs)
    symbols = take("<u2", n_symbols)
    if width > 16:
        symbols = symbols.astype(np.uint32)
        for bit in range(16, width):
            symbols |= np.unpackbits(take("u1", -(-n_symbols // 8)), count=n_symbols).astype(np.uint32) << np.uint32(bit)
    return Shard(base, left, right, lengths, symbols,
                 [None if null else i for i, null in zip(ids.tolist(), nulls)], sizes.astype(np.int64))


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def core_and_marks(word: bytes) -> tuple[bytes, bytes]:
    """A word in lower case without its closing punctuation, and that punctuation.

    The cut is made only behind an ASCII or Latin letter or digit, where a vocabulary that
    separates letters, digits and other characters cuts as well. Words that may hold a special
    string stay as they are.
    """
    if b"<|" in word:
        return word, b""
    low = word.translate(_LOWER)
    core = low.rstrip(_MARKS)
    if len(core) < len(low) and core and (core[-1:].isalnum() or core[-1] > 127 and "\u00c0" <= (end := core.decode()[-1]) <= "\u00ff" and end.isalpha()):
        return core, low[len(core):]
    return low, b""


#: Settings that drop white space and case and cut letters, digits and other characters apart.
WORDWISE = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}


class Encoder:
    """The library's ids of whole texts, each word between white space encoded once.

    That is the same for a vocabulary whose settings are ``WORDWISE``; other vocabularies get whole texts. Words are
    known by their 64-bit hashes; after ``most`` of them all are forgotten.
    """

    def __init__(self, path: str, most: int = 4_000_000):
        from tokenizers import Tokenizer
        self.vocabulary = Tokenizer.from_file(path)
        self.vocabulary.no_truncation()
        self.vocabulary.no_padding()
        self.most, self.split = most, self.splits_words()
        closing = [i for token, i in self.vocabulary.get_vocab().items() if token.endswith("</w>")]
        self.closing = np.zeros(self.vocabulary.get_vocab_size(), bool) if closing else None
        if closing:
            self.closing[closing] = True
        self.forget()

    def forget(self) -> None:
        """Nothing is known. ``hashes`` is ascending, ``entry`` says where a word's ids are."""
        self.hashes, self.entry = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.flat, self.ends, self.count = np.empty(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), 0

    def splits_words(self) -> bool:
        """Whether the vocabulary's own settings say that words between white space are encoded each by itself,
        whatever their case, and letters apart from the punctuation behind them."""
        told = json.loads(self.vocabulary.to_str())
        plain = all(t["content"].startswith("<|") and not any(t[k] for k in ("single_word", "lstrip", "rstrip", "normalized"))
                    for t in told["added_tokens"])
        return plain and told["model"].get("dropout") is None and all(told[k] == v for k, v in WORDWISE.items())

    def _store(self, hashes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """New words' ids, one after the other, and the number of each."""
        first, old = self.count, int(self.ends[self.count])
        self.count += len(hashes)
        while len(self.ends) <= self.count:
            self.ends = np.concatenate((self.ends, np.zeros_like(self.ends)))
        while len(self.flat) < old + len(ids):
            self.flat = np.concatenate((self.flat, np.empty_like(self.flat)))
        self.ends[first + 1:self.count + 1] = old + np.cumsum(counts)
        self.flat[old:old + len(ids)] = ids
        hashes, entry = np.concatenate((self.hashes, hashes)), np.concatenate((self.entry, np.arange(first, self.count)))
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.entry = hashes[order], entry[order]

    def _place(self, hashes: np.ndarray) -> np.ndarray:
        """The entry of each word, -1 where it is not known."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.entry[at], -1)

    def _fetch(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the entries one after the other, and the number of each."""
        starts = self.ends[place]
        counts = self.ends[place + 1] - starts
        ends = np.cumsum(counts)
        return self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)], counts

    def _by_library(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Words of ASCII letters go many to a text: each ends with the only id in it that
        stands for the end of a word. All others are encoded one by one."""
        found: list[list[int] | np.ndarray] = [[]] * len(words)
        letters = [i for i, w in enumerate(words) if w.isalpha()] if self.closing is not None else []
        for at in range(0, len(letters), 1024):
            some = letters[at:at + 1024]
            text = b" ".join([words[i] for i in some]).decode()
            ids = np.array(self.vocabulary.encode(text, add_special_tokens=False).ids, np.uint32)
            ends = np.flatnonzero(self.closing[ids]) + 1
            if len(ends) == len(some):
                for i, a, z in zip(some, [0, *ends.tolist()], ends.tolist()):
                    found[i] = ids[a:z]
        rest = [i for i, f in enumerate(found) if not len(f)]
        for i, e in zip(rest, self.vocabulary.encode_batch_fast([words[i].decode() for i in rest], add_special_tokens=False)):
            found[i] = e.ids
        counts = np.array([len(f) for f in found], np.int64)
        return np.concatenate([np.empty(0, np.uint32), *(np.asarray(f, np.uint32) for f in found)]), counts

    def _learn(self, words: list[bytes], hashes: np.ndarray) -> None:
        parts = [core_and_marks(w) for w in words]
        pieces = list(dict.fromkeys(p for both in parts for p in both if p))
        own, _ = word_hashes([b" ".join(pieces)])
        new = np.flatnonzero(self._place(own) < 0)
        self._store(own[new], *self._by_library([pieces[i] for i in new.tolist()]))
        rest = np.flatnonzero(self._place(hashes) < 0)
        # The words that are not pieces themselves: the ids of the core, then those of the marks.
        place = dict(zip(pieces, self._place(own).tolist()))
        ids, counts = self._fetch(np.array([place[p] for i in rest.tolist() for p in parts[i] if p], np.int64))
        several = np.array([bool(parts[i][0]) + bool(parts[i][1]) for i in rest.tolist()], np.int64)
        ends = np.cumsum(several)
        totals = np.concatenate(([0], np.cumsum(counts)))
        self._store(hashes[rest], ids, totals[ends] - totals[ends - several])

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of each."""
        if not self.split:
            ids = [self.vocabulary.encode((t or b"").decode(), add_special_tokens=False).ids for t in texts]
            return np.array([i for x in ids for i in x], np.uint32), np.array([len(x) for x in ids], np.int64)
        hashes, sizes, joined, starts, ends = located_words(
            [t if not t or b"<|" in t else t.translate(_LOWER) for t in texts])
        if self.count > self.most:
            self.forget()
        order = np.argsort(hashes)
        ordered = hashes[order]
        heads = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else order
        place = self._place(ordered[heads])
        new = np.flatnonzero(place < 0)
        if len(new):
            at = order[heads[new]]
            self._learn([joined[a:z] for a, z in zip(starts[at].tolist(), ends[at].tolist())], hashes[at])
            place[new] = self._place(hashes[at])
        of_words = np.empty(len(hashes), np.int64)
        of_words[order] = np.repeat(place, np.diff(np.append(heads, len(order))))
        ids, counts = self._fetch(of_words)
        return ids, np.diff(np.concatenate(([0], np.cumsum(counts)))[np.concatenate(([0], np.cumsum(sizes)))])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core is one task's share
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def with_ends(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The end id after the tokens of each document."""
    return np.insert(ids, np.cumsum(counts), np.uint32(end_id)), counts + 1


def write_tokens(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                 end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> None:
    """Write the shards of all documents in ascending order of their ids under ``path``."""
    spark = docs.sparkSession
    tie = F.xxhash64(quoted(text))
    keyed = docs.select(quoted(doc_id).cast("bigint").alias("id"), quoted(text).cast("binary").alias("text"), tie.alias("tie"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = keyed.repartitionByRange(parts, "id", "tie").sortWithinPartitions("id", "tie")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        held: list[tuple[list, np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            ids = [i for h in held for i in h[0]]
            tokens, sizes = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            block = pack(compress(tokens, ids, sizes))
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "shard": pa.array([number], pa.int32()),
                "n_docs": [len(ids)], "n_tokens": [len(tokens)], "block": [block]})

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                piece = batch.slice(at, 1024)
                tokens, sizes = with_ends(*encoder(tokenizer).encode(piece.column("text").to_pylist()), end_id)
                held.append((piece.column("id").to_pylist(), tokens, sizes))
                if sum(len(h[1]) for h in held) >= shard_tokens:
                    yield flush()
                    held.clear()
                    number += 1
        if held:
            yield flush()

    ordered.mapInArrow(shards, BLOCKS).write.mode("overwrite").parquet(path)


def shard_starts(blocks: DataFrame) -> DataFrame:
    """``(part, shard, start)``: tokens before each shard.

    Totals of parts are summed in one place, one row for each part; shards only within theirs.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocks.select("part", "shard", "n_tokens")
    parts = (sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start")))
    return (sizes.withColumn("within", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(parts, "part")
            .select("part", "shard", (F.col("part_start") + F.col("within")).alias("start")))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, decoded from the shards."""
    blocks = spark.read.schema(BLOCKS).parquet(path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, shard, block in zip(*(batch.column(c) for c in ("part", "shard", "block"))):
                read = unpack(block.as_buffer().to_pybytes())
                tokens = read.tokens().astype("<u4")
                ends = np.cumsum(read.sizes)
                starts = ends - read.sizes
                crc = [zlib.crc32(tokens[a:z]) for a, z in zip(starts.tolist(), ends.tolist())]
                n = len(read.ids)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part.as_py()] * n, pa.int32()), "shard": pa.array([shard.as_py()] * n, pa.int32()),
                    "doc_id": pa.array(read.ids, pa.int64()), "place": starts, "n_tokens": read.sizes,
                    "ids_crc32": pa.array(crc, pa.int64())})

    told = blocks.select("part", "shard", "block").mapInArrow(
        decode, "part int, shard int, doc_id bigint, place bigint, n_tokens bigint, ids_crc32 bigint")
    return (told.join(shard_starts(blocks), ["part", "shard"])
            .select("doc_id", (F.col("start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"))


def tokenise(docs: DataFrame) -> DataFrame:
    """Write the documents' shards to the shared folder and read them back."""
    import public_tokenizers

    path = scratch_path(docs.sparkSession, "token-shards")
    write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(docs.sparkSession, path)


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return tokenise(table(spark, folder, "documents").select("doc_id", "text"))


QUERIES = {"op7_token_files": op7_token_files}
ORACLES: dict[str, str] = {}
