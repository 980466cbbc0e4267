"""Suffix arrays by induced sorting, and permuted common prefixes, with numpy.

Over bytes, inducing works bucket by bucket: the suffixes that a bucket's entries put into later buckets are known at
once, those it puts into itself come in rounds, one for each further repetition of its character. So a pass over
the alphabet is a few array operations per character. The reduced strings of deeper levels have large
alphabets and are induced entry by entry; the rest of a level is array operations.
"""

from __future__ import annotations

import numpy as np

from headway.llm.texts import expand

SEPARATOR = 1
_SHIFT = 2


def joined_pieces(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, starts): byte pieces as one array of symbols, a separator after each and the end symbol 0 at the end."""
    lengths = np.diff(offsets)
    starts = offsets[:-1] + np.arange(len(lengths))
    text = np.full(len(data) + len(lengths) + 1, SEPARATOR, dtype=np.int32)
    text[expand(starts, lengths)] = data.astype(np.int32) + _SHIFT
    text[-1] = 0
    return text, starts


def _types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one that starts after it; the last (the end symbol) counts as such."""
    n = len(text)
    differs = np.append(text[:-1] != text[1:], True)
    smaller = np.append(text[:-1] < text[1:], True)
    places = np.flatnonzero(differs)
    return smaller[places[np.searchsorted(places, np.arange(n))]]


def _leftmost(smaller: np.ndarray) -> np.ndarray:
    return np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1


def _scatter(order: np.ndarray, made: np.ndarray, symbols: np.ndarray, edge: np.ndarray, step: int) -> None:
    """Append suffixes to the buckets of their first symbols, in the order given, from ``edge`` on or backwards."""
    by = np.argsort(symbols, kind="stable")
    symbols, made = symbols[by], made[by]
    first = np.flatnonzero(np.diff(symbols, prepend=-1))
    counts = np.diff(np.append(first, len(symbols)))
    nth = np.arange(len(symbols)) - np.repeat(first, counts)
    order[edge[symbols] + step * nth] = made
    edge[symbols[first]] += step * counts


def _induce(text: np.ndarray, before: np.ndarray, starts: np.ndarray, ends: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """Suffix order induced from leftmost-smaller suffixes in the order given. ``before[i]`` is the symbol before i."""
    order = np.full(len(text), -1, dtype=np.int64)
    first_of, seeds = text[leftmost], [None] * len(starts)
    by = np.argsort(first_of, kind="stable")
    cuts = np.searchsorted(first_of[by], np.arange(len(starts) + 1))
    grouped = leftmost[by]
    for c in range(len(starts)):
        seeds[c] = grouped[cuts[c] : cuts[c + 1]]

    head = starts.copy()
    for c in range(len(starts)):
        if starts[c] == ends[c]:
            continue
        done = starts[c]
        while done < head[c]:  # larger suffixes that this bucket puts into itself
            fresh = order[done : head[c]]
            done = head[c]
            more = fresh[before[fresh] == c] - 1
            order[head[c] : head[c] + len(more)] = more
            head[c] += len(more)
        entries = np.concatenate([order[starts[c] : head[c]], seeds[c]])
        symbols = before[entries]
        onward = symbols > c
        if onward.any():
            _scatter(order, entries[onward] - 1, symbols[onward], head, 1)

    tail = ends - 1
    for c in range(len(starts) - 1, -1, -1):
        if starts[c] == ends[c]:
            continue
        done = ends[c] - 1
        while done > tail[c]:
            fresh = order[tail[c] + 1 : done + 1][::-1]
            done = tail[c]
            more = fresh[before[fresh] == c] - 1
            order[tail[c] + 1 - len(more) : tail[c] + 1] = more[::-1]
            tail[c] -= len(more)
        smaller_ones = order[tail[c] + 1 : ends[c]][::-1]
        entries = np.concatenate([smaller_ones, order[starts[c] : head[c]][::-1]])
        symbols = before[entries]
        onward = (symbols < c) & (symbols >= 0)
        if onward.any():
            _scatter(order, entries[onward] - 1, symbols[onward], tail, -1)
    # The end symbol's suffix is induced by nothing.
    order[0] = len(text) - 1
    return order


def _names(text: np.ndarray, leftmost: np.ndarray, in_order: np.ndarray) -> tuple[np.ndarray, int]:
    """Rank of each leftmost-smaller substring (equal ones alike), in text order, and how many ranks there are."""
    following = np.append(leftmost[1:], len(text) - 1)
    rank_of_place = np.empty(len(text), dtype=np.int64)
    rank_of_place[leftmost] = np.arange(len(leftmost))
    nth = rank_of_place[in_order]
    lengths = (following - leftmost + 1)[nth]
    starts = leftmost[nth]
    new = np.ones(len(starts), dtype=bool)
    alike = np.flatnonzero(lengths[1:] == lengths[:-1]) + 1
    if len(alike):
        one, two = expand(starts[alike], lengths[alike]), expand(starts[alike - 1], lengths[alike])
        cut = np.concatenate([[0], np.cumsum(lengths[alike])[:-1]])
        new[alike] = np.logical_or.reduceat(text[one] != text[two], cut)
    names = np.empty(len(leftmost), dtype=np.int64)
    names[nth] = np.cumsum(new) - 1
    return names, int(new.sum())


def _bucket_order(names: np.ndarray) -> np.ndarray:
    order = np.empty(len(names), dtype=np.int64)
    order[names] = np.arange(len(names))
    return order


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes of small non-negative integers that end in a unique least symbol 0."""
    if len(text) == 1:
        return np.zeros(1, dtype=np.int64)
    smaller = _types(text)
    leftmost = _leftmost(smaller)
    counts = np.bincount(text)
    ends = np.cumsum(counts)
    starts = ends - counts
    before = np.concatenate([[-1], text[:-1]])
    order = _induce(text, before, starts, ends, leftmost)
    is_leftmost = np.zeros(len(text), dtype=bool)
    is_leftmost[leftmost] = True
    names, kinds = _names(text, leftmost, order[is_leftmost[order]])
    return _induce(text, before, starts, ends, leftmost[_reduced_order(names, kinds)])


def _induced_by_entry(text: list[int], smaller: bytes, counts: list[int], ends: list[int], seeds: list[int]) -> list[int]:
    """Suffix order induced from leftmost-smaller suffixes in the order given, one entry after the other.

    The lists are walked while they fill: an entry is always put ahead of where the walk is.
    """
    order = [-1] * len(text)
    tail = ends.copy()
    for i in reversed(seeds):
        symbol = text[i]
        tail[symbol] = place = tail[symbol] - 1
        order[place] = i
    head = [end - count for end, count in zip(ends, counts, strict=True)]
    for entry in order:
        if entry > 0 and not smaller[entry - 1]:
            symbol = text[entry - 1]
            place = head[symbol]
            order[place] = entry - 1
            head[symbol] = place + 1
    tail = ends.copy()
    for entry in reversed(order):
        if entry > 0 and smaller[entry - 1]:
            symbol = text[entry - 1]
            tail[symbol] = place = tail[symbol] - 1
            order[place] = entry - 1
    order[0] = len(text) - 1  # the end symbol's suffix is induced by nothing
    return order


def _reduced_order(text: np.ndarray, kinds: int) -> np.ndarray:
    """Suffix order of a reduced string; its last symbol is its unique least."""
    if kinds == len(text):
        return _bucket_order(text)
    smaller = _types(text)
    leftmost = _leftmost(smaller)
    counts = np.bincount(text, minlength=kinds)
    known = (text.tolist(), smaller.tobytes(), counts.tolist(), np.cumsum(counts).tolist())
    order = np.array(_induced_by_entry(*known, leftmost.tolist()), dtype=np.int64)
    is_leftmost = np.zeros(len(text), dtype=bool)
    is_leftmost[leftmost] = True
    ranked = leftmost[_reduced_order(*_names(text, leftmost, order[is_leftmost[order]]))]
    return np.array(_induced_by_entry(*known, ranked.tolist()), dtype=np.int64)


def common_prefixes(text: np.ndarray, order: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, partners): for each position the prefix it shares with the suffix sorted before it, inside its piece.

    The permuted order makes them cheap: a position whose left neighbour extends the match has one less than
    that neighbour. Only the others are compared symbol by symbol, eight at a time.
    """
    n = len(text)
    partner = np.full(n, -1, dtype=np.int64)
    partner[order[1:]] = order[:-1]
    piece_end = np.append(starts[1:] - 1, n - 2)
    own_end = piece_end[np.maximum(0, np.searchsorted(starts, np.arange(n), side="right") - 1)]
    left = np.concatenate([[-1], text[:-1]])
    fresh = (partner <= 0) | (left != left[np.maximum(partner, 0)])
    fresh[starts] = True
    places = np.flatnonzero(fresh & (partner >= 0))
    symbols = np.append(text, np.zeros(8, dtype=text.dtype)).astype(np.uint64)
    # Symbols have nine bits; seven of them fill a word.
    words = np.zeros(n, dtype=np.uint64)
    for k in range(7):
        words = (words << np.uint64(9)) | symbols[k : k + n]
    found = np.zeros(n, dtype=np.int64)
    a, b = places, partner[places]
    length = np.zeros(len(places), dtype=np.int64)
    active = np.arange(len(places))
    while len(active):
        i, j = a[active] + length[active], b[active] + length[active]
        inside = (i < own_end[a[active]]) & (j < n)
        same = np.zeros(len(active), dtype=bool)
        same[inside] = words[i[inside]] == words[j[inside]]
        rest = active[~same & inside]
        length[active[same]] += 7
        for _ in range(7):
            if len(rest) == 0:
                break
            i, j = a[rest] + length[rest], b[rest] + length[rest]
            ok = (i < n) & (j < n)
            ok[ok] = text[i[ok]] == text[j[ok]]
            rest = rest[ok]
            length[rest] += 1
        active = active[same]
    found[places] = np.minimum(length, np.maximum(0, own_end[places] - places))
    last = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    return np.maximum(0, np.minimum(found[last] - (np.arange(n) - last), own_end - np.arange(n))), partner
