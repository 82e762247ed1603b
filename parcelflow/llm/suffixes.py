"""Suffix arrays by induced sorting, and permuted longest common prefixes, with numpy.

Suffixes are classified as larger (L) or smaller (S) than the next one. The leftmost of each run of S suffixes (LMS) are
sorted first: their substrings are sorted by one induction, named, and the shorter text of names is sorted in the same
way, recursively. A second induction then places all others. With few symbols, induction goes through the buckets of
first symbols in order and places what one bucket induces with a few whole-array operations; with many, as texts of names
have, it goes place by place with an array of bucket heads. Either way its work is linear in the text.
"""

from __future__ import annotations

import numpy as np

#: Texts of more symbols than this are induced place by place: whole-array operations for each bucket would no longer pay.
MOST_BUCKETS = 1024


def _types(text: np.ndarray) -> np.ndarray:
    """True for S suffixes. A virtual smallest symbol follows the last one."""
    runs = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    symbols = text[runs]
    rises = np.append(symbols[:-1] < symbols[1:], False)  # a run is decided by the symbol after it
    return np.repeat(rises, np.diff(np.append(runs, len(text))))


def _deal(text: np.ndarray, who: np.ndarray, queues: list[list[np.ndarray]]) -> None:
    """Append suffixes to the queues of their first symbols, keeping their order."""
    if not len(who):
        return
    symbols = text[who]
    order = np.argsort(symbols, kind="stable")
    symbols, who = symbols[order], who[order]
    cuts = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
    starts = [0, *cuts.tolist()]
    for a, b in zip(starts, [*starts[1:], len(who)]):
        queues[symbols[a]].append(who[a:b])


def _induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray, symbols: int) -> np.ndarray:
    """All suffixes in order, from the LMS ones in theirs."""
    n = len(text)
    none = np.zeros(0, lms.dtype)
    starts: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    _deal(text, lms, starts)
    queues: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    queues[text[n - 1]].append(np.array([n - 1], lms.dtype))
    large: list[np.ndarray] = [none] * symbols
    for c in range(symbols):
        placed, induced = [], []
        wave = np.concatenate(queues[c]) if queues[c] else none
        while len(wave):
            placed.append(wave)
            before = wave[wave > 0] - 1
            before = before[~small[before]]
            same = text[before] == c
            induced.append(before[~same])
            wave = before[same]
        induced += [x[x > 0] - 1 for x in starts[c]]
        large[c] = np.concatenate(placed) if placed else none
        queues[c] = []
        if induced:
            _deal(text, np.concatenate(induced), queues)
    out: list[np.ndarray] = []
    for c in range(symbols - 1, -1, -1):
        placed, induced = [], []
        wave = np.concatenate(queues[c]) if queues[c] else none
        while len(wave):
            placed.append(wave)
            before = wave[wave > 0] - 1
            before = before[small[before]]
            same = text[before] == c
            induced.append(before[~same])
            wave = before[same]
        last = large[c][::-1]
        before = last[last > 0] - 1
        induced.append(before[small[before]])
        queues[c] = []
        _deal(text, np.concatenate(induced), queues)
        out += [*placed, last]
    return np.concatenate(out)[::-1]


def _induce_names(text: np.ndarray, small: np.ndarray, lms: np.ndarray, symbols: int) -> np.ndarray:
    """The same for texts of many symbols, whose buckets are short: one place after another."""
    before = np.append(-1, text[:-1]).astype(np.int64)  # the bucket of the suffix before each one, -1 if it is of the other kind
    is_small = np.append(False, small[:-1])
    large_before = np.append(np.where(is_small, -1, before), -1).tolist()  # an empty place, -1, reads the last value
    small_before = np.where(is_small, before, -1).tolist()
    tails = np.cumsum(np.bincount(text, minlength=symbols))
    heads = np.append(0, tails[:-1]).tolist()
    first = text[lms]
    by_symbol = np.argsort(first, kind="stable")
    first = first[by_symbol]
    start = np.searchsorted(first, first, "left")
    end = np.searchsorted(first, first, "right")
    n = len(text)
    placed = np.full(n, -1, np.int64)
    placed[tails[first] - (end - start) + np.arange(len(first)) - start] = lms[by_symbol]
    order = placed.tolist()
    tails = tails.tolist()
    order[heads[text[-1]]] = n - 1
    heads[text[-1]] += 1
    for i in order:  # grows behind the place that is read
        c = large_before[i]
        if c >= 0:
            h = heads[c]
            order[h] = i - 1
            heads[c] = h + 1
    for i in reversed(order):
        c = small_before[i]
        if c >= 0:
            h = tails[c] = tails[c] - 1
            order[h] = i - 1
    return np.array(order, lms.dtype)


def suffix_array(text: np.ndarray, symbols: int = 256) -> np.ndarray:
    """Starts of the suffixes of an integer array (values under `symbols`) in lexicographic order."""
    n = len(text)
    kind = np.int32 if n < 1 << 31 else np.int64
    if n < 2:
        return np.arange(n, dtype=kind)
    induce = _induce if symbols <= MOST_BUCKETS else _induce_names
    small = _types(text)
    lms = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(kind)
    if len(lms) > 1:
        order = induce(text, small, lms, symbols)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        order = order[is_lms[order]]  # by their substrings
        until = np.zeros(n, kind)  # last place of the substring: the next LMS; past the end for the last one
        until[lms[:-1]] = lms[1:]
        until[lms[-1]] = n
        a, b = order[:-1], order[1:]
        length = until[a] - a
        equal = (length == until[b] - b) & (until[a] < n) & (until[b] < n)
        alive = np.flatnonzero(equal)
        k = 0
        while len(alive):
            ok = text[a[alive] + k] == text[b[alive] + k]
            equal[alive[~ok]] = False
            alive = alive[ok & (length[alive] > k)]
            k += 1
        names = np.cumsum(np.concatenate([[0], ~equal]))
        if names[-1] + 1 < len(lms):
            named = np.zeros(n, kind)
            named[order] = names
            order = lms[suffix_array(named[lms], int(names[-1]) + 1)]
        lms = order
    return induce(text, small, lms, symbols)


def common_prefixes(text: np.ndarray, order: np.ndarray, wall: int) -> tuple[np.ndarray, np.ndarray]:
    """(plcp, before): of each suffix, the suffix before it in order (itself for the first) and the length of their common
    prefix, in text order. A `wall` symbol equals nothing, so prefixes end there.

    In text order a value is one less than the last, unless the symbols on the left differ; only these values are
    compared symbol by symbol (Karkkainen, Manzini and Puglisi's irreducible ones).
    """
    n = len(text)
    kind = order.dtype
    before = np.empty(n, kind)
    before[order[1:]] = order[:-1]
    before[order[0]] = order[0]
    here = np.arange(n, dtype=kind)
    left = np.roll(text, 1)
    fresh = (left != left[before]) | (left == wall)
    fresh |= before == here
    fresh[1:] |= before[1:] != before[:-1] + 1
    fresh[0] = True
    fresh[before == 0] = True
    at = here[fresh]
    value = np.zeros(len(at), kind)
    other = before[at]
    alive = np.flatnonzero(other != at)
    k = 0
    while len(alive):
        a, b = at[alive] + kind.type(k), other[alive] + kind.type(k)
        inside = np.maximum(a, b) < n
        alive, a, b = alive[inside], a[inside], b[inside]
        ok = (text[a] == text[b]) & (text[a] != wall)
        alive = alive[ok]
        k += 1
        value[alive] = k
    length = np.repeat(value + at, np.diff(np.append(at, n)))
    length -= here
    return np.maximum(length, 0, out=length), before
