"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

Induction goes bucket by bucket of the first symbol.  All suffixes that a
bucket induces are placed in one step, because their order is the order in
which the bucket lists them; only runs of one symbol take a step each."""

from __future__ import annotations

import numpy as np

#: Larger alphabets (names of sorted substrings) are sorted by doubled ranks.
SMALL_ALPHABET = 1024


def classify(text: np.ndarray) -> np.ndarray:
    """True for suffixes smaller than the one after them (S), else False (L).
    The last symbol is the unique least one and counts as S."""
    n = len(text)
    step = np.sign(text[1:].astype(np.int64) - text[:-1])
    where = np.where(step != 0, np.arange(n - 1), n)
    # The next place at which neighbours differ decides.
    where = np.minimum.accumulate(where[::-1])[::-1] if n > 1 else where
    small = np.ones(n, bool)
    small[:-1] = step[np.minimum(where, max(n - 2, 0))] > 0
    return small


def leftmost_smaller(small: np.ndarray) -> np.ndarray:
    """Places of S suffixes right after an L suffix."""
    return np.flatnonzero(small[1:] & ~small[:-1]) + 1


def _induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, alphabet: int) -> np.ndarray:
    """The suffix array that follows from the order of the leftmost-smaller
    suffixes `seeds` (of their first parts, if those are what is ordered)."""
    n = len(text)
    counts = np.bincount(text, minlength=alphabet)
    heads = np.concatenate([[0], np.cumsum(counts)])
    present = np.flatnonzero(counts)
    array = np.full(n, -1, np.int64)
    by_symbol = seeds[np.argsort(text[seeds], kind="stable")]
    seed_cuts = np.searchsorted(text[by_symbol], np.arange(alphabet + 1))

    def place(found: np.ndarray, free: np.ndarray, step: int) -> None:
        """Puts suffixes at the free end of their buckets, in order."""
        symbols = text[found]
        order = np.argsort(symbols, kind="stable")
        found, symbols = found[order], symbols[order]
        first = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
        sizes = np.diff(np.append(first, len(symbols)))
        rank = np.arange(len(symbols)) - np.repeat(first, sizes)
        array[free[symbols] + step * rank] = found
        free[symbols[first]] += step * sizes

    # L suffixes, from the least bucket up: first its own L part, then its seeds.
    free = heads[:-1].copy()
    for c in present:
        at = heads[c]
        while at < free[c]:
            end = free[c]
            before = array[at:end] - 1
            at = end
            before = before[before >= 0]
            before = before[~small[before]]
            if len(before):
                place(before, free, 1)
        before = by_symbol[seed_cuts[c]:seed_cuts[c + 1]] - 1
        before = before[before >= 0]
        if len(before):
            place(before, free, 1)
    # S suffixes, from the greatest bucket down: first its own S part, then its L part.
    large_end = free
    free = heads[1:] - 1
    for c in present[::-1]:
        at = heads[c + 1] - 1
        while at > free[c]:
            end = free[c]
            before = array[end + 1:at + 1][::-1] - 1
            at = end
            before = before[before >= 0]
            before = before[small[before]]
            if len(before):
                place(before, free, -1)
        before = array[heads[c]:large_end[c]][::-1] - 1
        before = before[before >= 0]
        before = before[small[before]]
        if len(before):
            place(before, free, -1)
    array[0] = n - 1
    return array


def _names(text: np.ndarray, ordered: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Ranks of the leftmost-smaller substrings given in sorted order; equal
    substrings share a rank."""
    ends = np.append(places[1:], len(text) - 1) + 1
    length = np.zeros(len(text), np.int64)
    length[places] = ends - places
    a, b = ordered[:-1], ordered[1:]
    equal = length[a] == length[b]
    live = np.flatnonzero(equal)
    k = 0
    while len(live):
        live = live[length[a[live]] > k]
        differ = text[a[live] + k] != text[b[live] + k]
        equal[live[differ]] = False
        live = live[~differ]
        k += 1
    return np.concatenate([[0], np.cumsum(~equal)])


def _by_doubling(ranks: np.ndarray) -> np.ndarray:
    """Suffix array of a string with a large alphabet: ranks of 1, 2, 4, ...
    symbols; only suffixes that are still tied are sorted again."""
    n = len(ranks)
    order = np.argsort(ranks, kind="stable")
    sorted_ranks = ranks[order]
    new = np.concatenate([[True], sorted_ranks[1:] != sorted_ranks[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))  # least place of the class
    k = 1
    while True:
        tied = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(tied):
            return order
        some = order[tied]
        ahead = np.where(some + k < n, rank[np.minimum(some + k, n - 1)], -1)
        inner = np.lexsort((ahead, rank[some]))
        some, ahead = some[inner], ahead[inner]
        order[tied] = some
        changed = np.concatenate([[True], (rank[some][1:] != rank[some][:-1]) | (ahead[1:] != ahead[:-1])])
        new[tied] |= changed
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        k *= 2


def suffix_array(text: np.ndarray, alphabet: int) -> np.ndarray:
    """Suffix array of `text` (integers below `alphabet`; the last symbol is 0
    and occurs once)."""
    n = len(text)
    if n < 3:
        return np.arange(n)[::-1].copy()
    small = classify(text)
    places = leftmost_smaller(small)
    rough = _induce(text, small, places, alphabet)
    is_place = np.zeros(n, bool)
    is_place[places] = True
    ordered = rough[is_place[rough]]
    names = _names(text, ordered, places)
    if names[-1] + 1 < len(places):
        by_place = np.empty(n, np.int64)
        by_place[ordered] = names
        reduced = by_place[places]
        inner = suffix_array(reduced, int(names[-1]) + 1) if names[-1] < SMALL_ALPHABET else _by_doubling(reduced)
        ordered = places[inner]
    return _induce(text, small, ordered, alphabet)


def permuted_common_prefixes(text: np.ndarray, array: np.ndarray, stop: int) -> np.ndarray:
    """For each place, how many symbols its suffix shares with the one before
    it in the array; symbols up to `stop` end a match.  Where the symbol
    before equals that before the neighbour, the value is one less than that
    of the place before; the other places are compared symbol by symbol."""
    n = len(text)
    neighbour = np.full(n, -1, np.int64)
    neighbour[array[1:]] = array[:-1]
    left = np.arange(n) - 1
    other = neighbour - 1
    reducible = (left >= 0) & (other >= 0)
    reducible[reducible] = (text[left[reducible]] == text[other[reducible]]) & (text[left[reducible]] > stop)
    own = np.flatnonzero(~reducible & (neighbour >= 0))
    length = np.zeros(n, np.int64)
    live, k = own, 0
    while len(live):
        a, b = live + k, neighbour[live] + k
        inside = (a < n) & (b < n)
        live, a, b = live[inside], a[inside], b[inside]
        match = (text[a] == text[b]) & (text[a] > stop)
        live = live[match]
        length[live] += 1
        k += 1
    last = np.maximum.accumulate(np.where(reducible, 0, np.arange(n)))
    return np.maximum(np.where(reducible, length[last] - (np.arange(n) - last), length), 0)
