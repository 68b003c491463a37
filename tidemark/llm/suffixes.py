"""Suffix arrays by induced sorting, vectorised: whole buckets are induced at a time."""

from __future__ import annotations

import numpy as np


def _types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one. The last symbol is a unique smallest sentinel."""
    n = len(s)
    step = np.sign(np.diff(s.astype(np.int64)))
    at = np.where(step != 0, np.arange(n - 1), n - 1)
    nearest = np.minimum.accumulate(at[::-1])[::-1]
    small = np.ones(n, bool)
    small[:-1] = np.append(step, 1)[nearest] > 0
    return small


def _spread(queues: list[list[np.ndarray]], places: np.ndarray, symbols: np.ndarray) -> None:
    """Append each place to the queue of its symbol, in order."""
    if not len(places):
        return
    order = np.argsort(symbols, kind="stable")
    symbols, places = symbols[order], places[order]
    cuts = np.flatnonzero(np.diff(symbols)) + 1
    for first, part in zip(np.append(0, cuts), np.split(places, cuts), strict=True):
        queues[symbols[first]].append(part)


def _closed(parts: list[np.ndarray], s: np.ndarray, wanted: np.ndarray, symbol: int) -> np.ndarray:
    """The queue with all it induces in its own bucket: runs of one symbol, one step of all runs at a time."""
    if not parts:
        return np.zeros(0, np.int64)
    out = [np.concatenate(parts)]
    while len(out[-1]):
        before = out[-1] - 1
        before = before[before >= 0]
        out.append(before[(s[before] == symbol) & wanted[before]])
    return np.concatenate(out)


def _induce(s: np.ndarray, small: np.ndarray, seeds: np.ndarray, sigma: int) -> np.ndarray:
    """All suffixes, induced from leftmost-smaller ones given in order: larger ones rightwards, smaller ones leftwards."""
    large = ~small
    seeded: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    _spread(seeded, seeds, s[seeds])
    right: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    larger: list[np.ndarray] = []
    for c in range(sigma):
        own = _closed(right[c], s, large, c)
        larger.append(own)
        before = np.concatenate([own, *seeded[c]]) - 1
        before = before[before >= 0]
        before = before[large[before] & (s[before] > c)]
        _spread(right, before, s[before])
        right[c] = []
    left: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    left[s[-1]].append(np.array([len(s) - 1]))
    out: list[np.ndarray] = []
    for c in range(sigma - 1, -1, -1):
        own = _closed(left[c], s, small, c)
        before = np.concatenate([own, larger[c][::-1]]) - 1
        before = before[before >= 0]
        before = before[small[before] & (s[before] < c)]
        _spread(left, before, s[before])
        out += [own, larger[c][::-1]]
    return np.concatenate(out)[::-1]


def _doubled(s: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string whose symbols are too many to walk bucket by bucket."""
    rank, k, n = s.astype(np.int64), 1, len(s)
    while True:
        after = np.zeros(n, np.int64)
        after[:n - k] = rank[k:] + 1
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.zeros(n, np.int64)
        new[order] = np.append(0, np.cumsum(key[1:] != key[:-1]))
        rank, k = new, 2 * k
        if rank.max() == n - 1 or k >= n:
            return np.argsort(rank, kind="stable")


def suffix_array(s: np.ndarray, sigma: int) -> np.ndarray:
    """Starts of the suffixes of ``s`` in order. The last symbol must be the only 0; symbols are below ``sigma``.

    Suffixes are classified, the leftmost-smaller substrings are sorted by induction and
    named, the string of names is sorted by recursion if names repeat, and its order induces
    that of all suffixes. With more names than a quarter of their string's length, or than
    2,048, the recursion ends in rank doubling, as a walk over buckets of a few places each
    would be slower.
    """
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    if sigma > 2048 or 4 * sigma > n + 2048:
        return _doubled(s)
    small = _types(s)
    marks = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    order = _induce(s, small, marks, sigma)
    is_mark = np.zeros(n, bool)
    is_mark[marks] = True
    order = order[is_mark[order]]
    ends = np.append(marks[1:], n - 1)
    length = np.zeros(n, np.int64)
    length[marks] = ends - marks
    a, b = order[:-1], order[1:]
    same = np.flatnonzero(length[a] == length[b])
    same = same[b[same] != n - 1]
    k, equal = 0, []
    while len(same):
        same = same[s[a[same] + k] == s[b[same] + k]]
        done = length[a[same]] == k
        equal.append(same[done])
        same, k = same[~done], k + 1
    fresh = np.ones(len(order), np.int64)
    fresh[0] = 0
    for pairs in equal:
        fresh[pairs + 1] = 0
    names = np.zeros(n, np.int64)
    names[order] = np.cumsum(fresh)
    names = names[marks]
    count = int(names.max()) + 1
    if count < len(marks):
        order = marks[suffix_array(names, count)]
    return _induce(s, small, order, sigma)


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Permuted common prefixes: at each place of ``order`` the bytes, ``most`` at most, that it shares with the place before it.

    ``data`` must go on for ``most`` + 8 bytes after each place.
    """
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    shared = np.zeros(len(data), np.int64)
    if len(order) < 2:
        return shared
    a, b, alive = order[:-1], order[1:], np.arange(len(order) - 1)
    length = np.zeros(len(alive), np.int64)
    for k in range(0, most, 8):
        differ = (words[a[alive] + k] != words[b[alive] + k])
        first = np.where(differ.any(1), differ.argmax(1), 8)
        length[alive] += first
        alive = alive[first == 8]
        if not len(alive):
            break
    shared[b] = np.minimum(length, most)
    return shared
