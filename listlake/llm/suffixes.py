"""Suffix arrays by induced sorting, and permuted common prefixes, as array operations.

Suffixes are classified as smaller or larger than their right neighbour. The leftmost smaller ones
(after a larger one) cut the text into substrings; these are sorted by inducing, named, and sorted for
good by recursion on the names. Inducing goes over the array once for the larger suffixes and once,
backwards, for the smaller ones; here in stretches that are as long as no new entry falls inside.
"""

from __future__ import annotations

import numpy as np


def _narrow(text: np.ndarray) -> np.ndarray:
    """In the fewest bytes: symbols of 16 bits are sorted by counting."""
    most = int(text.max()) if len(text) else 0
    return text.astype(np.uint16 if most < 1 << 16 else np.int32 if most < 1 << 31 else np.int64, copy=False)


def smaller(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one that starts after it; the last one counts as smaller."""
    n = len(text)
    out = np.ones(n, bool)
    if n > 1:
        step = text[1:] != text[:-1]
        index = np.where(step, np.arange(n - 1), n)
        ahead = np.minimum.accumulate(index[::-1])[::-1]  # the next place where the symbol changes
        known = ahead < n
        out[:-1][known] = text[ahead[known]] < text[ahead[known] + 1]
    return out


def _pass(array: np.ndarray, text: np.ndarray, wanted: np.ndarray, heads: np.ndarray) -> None:
    """Goes over ``array``; each suffix puts the one before it, if wanted, at the head of its symbol's bucket."""
    n, at, width = len(array), 0, 1024
    while at < n:
        part = array[at : at + width]
        slots = (part >= 0).nonzero()[0]
        if not len(slots):
            at += width
            width = min(2 * width, 1 << 20)
            continue
        before = part[slots] - 1
        slots += at
        place = (wanted[before] & (before >= 0)).nonzero()[0]
        end = at + width
        if len(place):
            before = before[place]
            symbol = text[before]
            order = symbol.argsort(kind="stable")
            ranked = symbol[order]
            to = np.empty(len(before), np.int64)
            to[order] = heads[ranked] + (np.arange(len(ranked)) - ranked.searchsorted(ranked))
            # Entries count as long as nothing that comes before them falls at or before their slot.
            limit = np.full(len(slots), n, np.int64)
            limit[place] = to
            limit = np.minimum.accumulate(limit)
            bad = (slots[1:] >= limit[:-1]).nonzero()[0]
            if len(bad):
                whole = int(bad[0]) + 1
                end = int(limit[whole - 1])
                count = int(place.searchsorted(whole))
                before, to, symbol = before[:count], to[:count], symbol[:count]
            elif limit[-1] < end:
                end = int(limit[-1])
            array[to] = before
            # Within a symbol later entries have later places, so the last one assigned is the greatest.
            heads[symbol] = to + 1
            width = max(256, 2 * (end - at)) if end < at + width else min(2 * width, 1 << 20)
        at = end


def _induced(text: np.ndarray, small: np.ndarray, starts: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """The suffix array that follows from the order of the leftmost smaller suffixes."""
    n = len(text)
    array = np.full(n, -1, np.int32 if n < 1 << 31 else np.int64)
    symbol = text[leftmost]
    order = np.argsort(symbol, kind="stable")
    ranked = symbol[order]
    count = np.bincount(symbol, minlength=len(starts) - 1)
    rank = np.arange(len(ranked)) - (np.cumsum(count) - count)[ranked]
    array[starts[1:][ranked] - count[ranked] + rank] = leftmost[order]
    _pass(array, text, ~small, starts[:-1].copy())
    # Only the larger suffixes stay, and all smaller ones are induced from the right.
    array[(array >= 0) & small[array]] = -1
    array[0] = n - 1
    tails = n - starts[1:]
    _pass(array[::-1], text, small, tails.copy())
    return array


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Of non-negative integers of which the last is 0 and the only 0."""
    n = len(text)
    if n < 3:
        return np.arange(n)[::-1].copy()
    text = _narrow(text)
    small = smaller(text)
    is_leftmost = np.zeros(n, bool)
    is_leftmost[1:] = small[1:] & ~small[:-1]
    leftmost = np.flatnonzero(is_leftmost)
    starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=int(text.max()) + 1))])
    array = _induced(text, small, starts, leftmost)
    ordered = array[is_leftmost[array]]
    # Names: equal substrings, up to and with the next leftmost place, get equal names.
    length = np.ones(n, np.int64)
    length[leftmost[:-1]] = np.diff(leftmost) + 1
    a, b = ordered[1:], ordered[:-1]
    same = length[a] == length[b]
    live = np.flatnonzero(same)
    step = 0
    while len(live):
        equal = text[a[live] + step] == text[b[live] + step]
        same[live[~equal]] = False
        live = live[equal]
        step += 1
        live = live[length[a[live]] > step]
    names = np.concatenate([[0], np.cumsum(~same)])
    if names[-1] + 1 < len(ordered):
        reduced = np.zeros(n, np.int64)
        reduced[ordered] = names
        ordered = leftmost[suffix_array(reduced[leftmost])]
    return _induced(text, small, starts, ordered)


def permuted_prefixes(text: np.ndarray, array: np.ndarray) -> np.ndarray:
    """For each place the common prefix of its suffix and the one before it in the array.

    Where the symbols to the left agree too, it is one less than that of the place to the left; only the
    other places compare symbols.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[array[1:]] = array[:-1]
    own = np.ones(n, bool)
    some = np.arange(1, n)[before[1:] > 0]
    own[some] = text[some - 1] != text[before[some] - 1]
    own[0] = True
    out = np.zeros(n, np.int64)
    live = np.flatnonzero(own & (before >= 0))
    step = 0
    while len(live):
        inside = (live + step < n) & (before[live] + step < n)
        live = live[inside]
        live = live[text[live + step] == text[before[live] + step]]
        out[live] += 1
        step += 1
    place = np.arange(n)
    last = np.maximum.accumulate(np.where(own, place, 0))
    return np.where(own, out, np.maximum(out[last] - (place - last), 0))


def repeated(pieces: list[bytes], rank: list[np.ndarray] | np.ndarray, length: int) -> np.ndarray:
    """Of all places of all pieces in a row: whether the ``length`` bytes from there occur at a place of lower rank.

    ``rank`` orders the places; equal ranks are not lower. Strings never cross pieces: each piece ends
    with a symbol of its own.
    """
    sizes = np.array([len(p) for p in pieces])
    total, count = int(sizes.sum()), len(pieces)
    text = np.zeros(total + count + 1, np.int64)
    at = np.arange(total) + np.repeat(np.arange(count), sizes)
    text[at] = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64) + count + 1
    text[np.cumsum(sizes + 1) - 1] = np.arange(count) + 1
    text = _narrow(text)
    array = suffix_array(text)
    common = permuted_prefixes(text, array)[array]
    ranks = np.full(len(text), np.iinfo(np.int64).max)
    ranks[at] = rank
    group = np.flatnonzero(common < length)
    lowest = np.minimum.reduceat(ranks[array], group)
    marks = np.zeros(len(text), bool)
    marks[array] = ranks[array] > np.repeat(lowest, np.diff(np.append(group, len(array))))
    return marks[at]
