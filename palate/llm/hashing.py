"""Hashes of words and of runs of words, for the operators that compare passages."""

from __future__ import annotations

import numpy as np


_RANDOM = np.random.default_rng(64)
_IS_WORD = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])
#: A random value for each byte of a word, none for white space, and a factor for its place.
_BYTE = np.where(_IS_WORD, _RANDOM.integers(1, 2**63, 256, dtype=np.uint64), np.uint64(0))
_PLACE = _RANDOM.integers(1, 2**63, 1 << 12, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SLICE = 1 << 17


def mixed(values: np.ndarray) -> np.ndarray:
    """64 well mixed bits for each 64-bit value."""
    out = values + np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(30)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(31))


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word between ASCII white space, and the number of words of each text."""
    hashes, counts, *_ = located_words(texts)
    return hashes, counts


def located_words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, bytes, np.ndarray, np.ndarray]:
    """The same, and all texts as one with the places where each word starts and ends.

    A word's hash is the sum over its bytes of a random value for the byte times a random
    factor for its place, mixed. All words of many texts are hashed by a few array operations.
    """
    joined = b" ".join([b"", *(t or b"" for t in texts), b""])
    whole = np.frombuffer(joined, np.uint8)
    inside = _IS_WORD[whole]
    turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = turns[::2], turns[1::2]
    out = np.empty(len(starts), np.uint64)
    for at in range(0, len(starts), _SLICE):
        first, last = starts[at:at + _SLICE], ends[at:at + _SLICE]
        piece, own = whole[first[0]:last[-1]], first - first[0]
        place = np.arange(len(piece)) - np.repeat(own, np.diff(np.append(own, len(piece))))
        terms = _BYTE[piece]
        terms *= _PLACE[place & (len(_PLACE) - 1)]
        if len(piece) and place.max() >= len(_PLACE):  # in very long words the round counts as well
            terms *= mixed((place // len(_PLACE)).astype(np.uint64)) | np.uint64(1)
        out[at:at + _SLICE] = np.add.reduceat(terms, own)
    edges = np.cumsum([1] + [len(t or b"") + 1 for t in texts])
    return mixed(out), np.diff(np.searchsorted(starts, edges)), joined, starts, ends


def fold(hashes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """One fingerprint for each run of ``len(factors)`` hashes."""
    n = len(hashes) - len(factors) + 1
    out = hashes[:n] * factors[0]
    for k in range(1, len(factors)):
        out += hashes[k:n + k] * factors[k]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def distinct(values: np.ndarray) -> np.ndarray:
    ordered = np.sort(values)
    return ordered[np.concatenate(([True], ordered[1:] != ordered[:-1]))] if len(ordered) else ordered
