"""Plain Python versions of what the operators compute, one text at a time."""

import collections
import itertools
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spaced(text):
    return SPACED.findall(text or "")


def plain(text):
    return PLAIN.findall((text or "").translate(LOW))


def runs(words, k):
    return [tuple(words[i:i + k]) for i in range(len(words) - k + 1)]


def shingles(text):
    words = plain(text)
    return collections.Counter(runs(words, 5) or ([tuple(words)] if words else []))


def probability_jaccard(x, y):
    keys = set(x) | set(y)
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in keys) for i in set(x) & set(y))


def grouped(nodes, pairs):
    """Connected groups of nodes."""
    group = {n: {n} for n in nodes}
    for a, b in pairs:
        if group[a] is not group[b]:
            group[a] |= group[b]
            for n in group[b]:
                group[n] = group[a]
    return {id(g): g for g in group.values()}.values()


def near_classes(rows, threshold=0.8):
    """Smallest id of each document's component over all pairs; ``rows``: {id: text}."""
    sets = {d: shingles(t) for d, t in rows.items()}
    root = {d: d for d in rows}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in itertools.combinations(sorted(rows), 2):
        x, y = sets[a], sets[b]
        shared = set(x) & set(y)
        # The similarity is at most the share of either side that is common.
        if not shared or min(sum(x[i] for i in shared) / sum(x.values()),
                             sum(y[i] for i in shared) / sum(y.values())) < threshold - 1e-9:
            continue
        if probability_jaccard(x, y) >= threshold - 1e-12:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {d: find(d) for d in rows}


def removed_words(rows, window=13):
    """Per id: which words stand under a window that starts in a document with a smaller id."""
    first = {}
    for d, text in sorted(rows.items()):
        for run in runs(spaced(text), window):
            first.setdefault(run, d)
    out = {}
    for d, text in rows.items():
        words = spaced(text)
        gone = [False] * len(words)
        for i, run in enumerate(runs(words, window)):
            if first[run] < d:
                gone[i:i + window] = [True] * window
        out[d] = gone
    return out


def repeated_words(text, window=8):
    words = spaced(text)
    often = collections.Counter(runs(words, window))
    return len({p for i, run in enumerate(runs(words, window)) if often[run] > 1 for p in range(i, i + window)})


def hit_words(text, items, window=10):
    """(words hit, ids of items with a window in the text)."""
    words, hit, ids = plain(text), set(), set()
    for item, item_text in items:
        own = plain(item_text)
        for run in runs(own, min(window, len(own))) if own else []:
            for i in range(len(words) - len(run) + 1):
                if tuple(words[i:i + len(run)]) == run:
                    hit |= set(range(i, i + len(run)))
                    ids.add(item)
    return len(hit), ids
