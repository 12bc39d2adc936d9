"""Suffix arrays by induced sorting, and permuted common prefixes, for one shard of text in numpy.

Suffixes are larger (L) or smaller (S) than their right neighbour; a leftmost S suffix (LMS) starts a piece. Pieces are
sorted by inducing, named, the string of names is sorted recursively, and the whole array is induced from it. Inducing
goes through the array in stretches: a stretch is taken as a whole if it puts nothing into itself, else cut there.
"""

from __future__ import annotations

import numpy as np

from tabwright.llm.blocks import WORD_BASE, Rolling

#: Longest stretch that is induced at once.
STRETCH = 1 << 15


def _grouped(c: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """j by symbol, in the given order within a symbol; the symbols present, where each begins, and their counts."""
    order = c.argsort(kind="stable")
    c = c[order]
    edges = np.flatnonzero(c[1:] != c[:-1])
    first = np.zeros(len(edges) + 1, np.int64)
    np.add(edges, 1, out=first[1:])
    counts = np.empty_like(first)
    np.subtract(first[1:], first[:-1], out=counts[:-1])
    counts[-1] = len(c) - first[-1]
    return j[order], c[first], first, counts


def _induce_larger(s: np.ndarray, small: np.ndarray, heads: np.ndarray, sa: np.ndarray) -> None:
    at, n, reach = 0, len(s), 64
    while at < n:
        end = min(n, at + reach)
        j = sa[at:end]
        j = j[j > 0] - 1
        j = j[~small[j]]
        if len(j):
            c = s[j]
            lowest = int(heads[c].min())
            if lowest < end:  # the stretch would put entries into itself: only what is before them is final
                reach = lowest - at
                continue
            j, symbols, first, counts = _grouped(c, j)
            sa[np.repeat(heads[symbols] - first, counts) + np.arange(len(j))] = j
            heads[symbols] += counts
        at, reach = end, min(max(reach, 16) * 2, STRETCH)


def _induce_smaller(s: np.ndarray, small: np.ndarray, tails: np.ndarray, sa: np.ndarray) -> None:
    end, reach = len(s), 64
    while end > 0:
        at = max(0, end - reach)
        j = sa[at:end][::-1]
        j = j[j > 0] - 1
        j = j[small[j]]
        if len(j):
            c = s[j]
            highest = int(tails[c].max())
            if highest >= at:
                reach = end - highest - 1
                continue
            j, symbols, first, counts = _grouped(c, j)
            sa[np.repeat(tails[symbols] + first, counts) - np.arange(len(j))] = j
            tails[symbols] -= counts
        end, reach = at, min(max(reach, 16) * 2, STRETCH)


def _induce(s: np.ndarray, small: np.ndarray, ends: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The array induced from LMS positions in the given order within each symbol."""
    sa = np.full(len(s), -1, np.int64)
    j, symbols, first, counts = _grouped(s[lms], lms)
    slots = np.repeat(ends[symbols] - counts - first, counts) + np.arange(len(j))
    sa[slots] = j
    _induce_larger(s, small, np.append(0, ends[:-1]), sa)
    sa[slots[1:]] = -1  # the end mark stays, the others are induced anew
    _induce_smaller(s, small, ends - 1, sa)
    return sa


def _sorted(s: np.ndarray, symbols: int) -> np.ndarray:
    """s ends with a 0 that occurs nowhere else."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    step = np.diff(s.astype(np.int64))
    places = np.where(step != 0, np.arange(n - 1), n)
    after = np.minimum.accumulate(places[::-1])[::-1]  # where the next different neighbours are
    small = np.append(step[after] > 0, True)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    ends = np.cumsum(np.bincount(s, minlength=symbols))
    if len(lms) > 1:
        sa = _induce(s, small, ends, lms)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        pieces = sa[is_lms[sa]]
        stop = np.full(n, n, np.int64)
        stop[lms[:-1]] = lms[1:] + 1
        prints = Rolling(s, WORD_BASE).ranges(pieces, stop[pieces])
        names = np.zeros(n, np.int64)
        names[pieces] = np.append(0, np.cumsum(prints[1:] != prints[:-1]))
        reduced = names[lms]
        most = int(reduced.max()) + 1
        if most < len(lms):
            order = _sorted(reduced.astype(np.int32), most)
        else:
            order = np.empty(most, np.int64)
            order[reduced] = np.arange(most)
        lms = lms[order]
    return _induce(s, small, ends, lms)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``text`` (small non-negative integers) in order."""
    if not len(text):
        return np.zeros(0, np.int64)
    s = np.append(text.astype(np.int64) + 1, 0)
    most = int(s.max()) + 1
    return _sorted(s.astype(np.uint16) if most < 1 << 16 else s, most)[1:]


def common_prefixes(text: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of ``text``: the suffix before it in the array (-1: none), and the length they have in common.

    In text order that length falls by at most 1 from one place to the next; where the symbols to the left are equal it
    falls by exactly 1. Only the other places are compared symbol by symbol.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    common = np.zeros(n, np.int64)
    places = np.arange(n)
    left = np.zeros(n, bool)
    both = (places > 0) & (before > 0)
    left[both] = text[places[both] - 1] == text[before[both] - 1]
    own = np.flatnonzero(~left & (before >= 0))
    active, size = own, 0
    while len(active):
        a, b = active + size, before[active] + size
        inside = np.maximum(a, b) < n
        active = active[inside]
        active = active[text[a[inside]] == text[b[inside]]]
        size += 1
        common[active] = size
    source = np.maximum.accumulate(np.where(left, 0, places))
    return before, np.maximum(common[source] - (places - source), 0)


def repeated_places(text: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` symbols from each place start anywhere else in ``text``, too."""
    marks = np.zeros(len(text), bool)
    before, common = common_prefixes(text, suffix_array(text))
    hit = np.flatnonzero(common >= length)
    marks[hit] = True
    marks[before[hit]] = True
    return marks
