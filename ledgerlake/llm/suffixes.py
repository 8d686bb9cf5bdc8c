"""Suffix arrays of byte strings by induced sorting, and their permuted common prefixes.

The text is a numpy array. Suffixes are small (S) or large (L) by their successor; the
leftmost small ones (LMS) are sorted by their substrings, named, and sorted as suffixes by
way of their names; the order of all others is induced from theirs, one bucket at a time and
within a bucket in waves, each of them one numpy step. The string of names has too many
symbols for buckets, so it is sorted by doubling the length of what its ranks stand for.
"""

from __future__ import annotations

import numpy as np


def small(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the next one; the last one is not."""
    size = len(text)
    out = np.zeros(size, bool)
    if size < 2:
        return out
    step = np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16))
    # An equal neighbour takes the kind of the first unequal one after it.
    where = np.where(step != 0, np.arange(size - 1), size - 1)
    where = np.minimum.accumulate(where[::-1])[::-1]
    out[:-1] = np.concatenate([step, [-1]])[where] > 0
    return out


def _induce(text: np.ndarray, kinds: np.ndarray, seeds: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The suffixes in the order that ordered LMS seeds induce."""
    size, symbols = len(text), len(bounds) - 1
    out = np.empty(size, np.int64)
    by_symbol = np.searchsorted(text[seeds], np.arange(symbols + 1))
    heads = bounds[:-1].copy()

    def place(found, ends, up):
        """Puts suffixes, grouped by symbol in their order, at the open ends of the buckets."""
        symbol = text[found]
        order = np.argsort(symbol, kind="stable")
        counts = np.bincount(symbol, minlength=symbols)
        first = np.cumsum(counts) - counts
        chosen = symbol[order]
        step = np.arange(len(found)) - first[chosen]
        out[ends[chosen] + step if up else ends[chosen] - 1 - step] = found[order]
        ends += counts if up else -counts

    def before(found, wanted):
        found = found[found > 0] - 1
        return found[kinds[found] == wanted]

    # The last suffix is large and comes first in its bucket.
    out[heads[text[-1]]] = size - 1
    heads[text[-1]] += 1
    for symbol in range(symbols):
        low = bounds[symbol]
        while low < heads[symbol]:
            high = heads[symbol]
            place(before(out[low:high], False), heads, True)
            low = high
        if by_symbol[symbol] < by_symbol[symbol + 1]:
            place(before(seeds[by_symbol[symbol] : by_symbol[symbol + 1]], False), heads, True)
    tails = bounds[1:].copy()
    for symbol in range(symbols - 1, -1, -1):
        high = bounds[symbol + 1]
        while high > tails[symbol]:
            low = tails[symbol]
            place(before(out[low:high][::-1], True), tails, False)
            high = low
        if bounds[symbol] < heads[symbol]:
            place(before(out[bounds[symbol] : heads[symbol]][::-1], True), tails, False)
    return out


def _named(text: np.ndarray, starts: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The names of the LMS substrings that begin at `starts`, equal ones alike; `order` sorts them."""
    size = len(text)
    ends = np.concatenate([starts[1:] + 1, [size]])
    length = np.zeros(size, np.int64)
    length[starts] = ends - starts
    a, b = order[:-1], order[1:]
    differs = length[a] != length[b]
    active = np.flatnonzero(~differs)
    offset = 0
    while len(active):
        x, y = a[active] + offset, b[active] + offset
        unequal = text[x] != text[y]
        differs[active[unequal]] = True
        offset += 1
        active = active[~unequal]
        active = active[length[a[active]] > offset]
    # The last substring runs to the end of the text, as no other does.
    rank = np.concatenate([[0], np.cumsum(differs | (a == starts[-1]) | (b == starts[-1]))])
    names = np.empty(size, np.int64)
    names[order] = rank
    return names[starts]


def _sorted_names(names: np.ndarray) -> np.ndarray:
    """The order of the suffixes of a string of many symbols.

    A rank is the number of suffixes known to be smaller; only those that share theirs go on.
    """
    size, width = len(names), 1
    counts = np.bincount(names)
    smaller = np.cumsum(counts) - counts
    rank = smaller[names]
    active = np.flatnonzero(counts[names] > 1)
    while len(active):
        follow = np.zeros(len(active), np.int64)
        inside = active + width < size
        follow[inside] = rank[active[inside] + width] + 1
        key = rank[active] * (size + 1) + follow
        order = np.argsort(key)
        active, key = active[order], key[order]
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        old = rank[active]
        group = np.maximum.accumulate(np.where(np.concatenate([[True], old[1:] != old[:-1]]), np.arange(len(old)), 0))
        first = np.maximum.accumulate(np.where(fresh, np.arange(len(old)), 0))
        rank[active] = old + first - group
        alone = fresh & np.concatenate([fresh[1:], [True]])
        active = active[~alone]
        width *= 2
    out = np.empty(size, np.int64)
    out[rank] = np.arange(size)
    return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The starts of the suffixes of a uint8 array, in order; a prefix comes before what it begins."""
    size = len(text)
    if size < 2:
        return np.arange(size)
    bounds = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=256))])
    kinds = small(text)
    starts = np.flatnonzero(kinds[1:] & ~kinds[:-1]) + 1
    if not len(starts):
        return _induce(text, kinds, starts, bounds)
    by_first = starts[np.argsort(text[starts], kind="stable")]
    order = _induce(text, kinds, by_first, bounds)
    leftmost = np.zeros(size, bool)
    leftmost[starts] = True
    names = _named(text, starts, order[leftmost[order]])
    if names.max() + 1 < len(names):
        seeds = starts[_sorted_names(names)]
    else:
        seeds = np.empty(len(names), np.int64)
        seeds[names] = starts
    return _induce(text, kinds, seeds, bounds)


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For every suffix, in text order, the length it shares with the suffix sorted before it.

    Where both are preceded by the same byte the length is one less than at the place before,
    so only the other places are compared, all at once in growing pieces.
    """
    size = len(text)
    out = np.zeros(size, np.int64)
    if size < 2:
        return out
    previous = np.full(size, -1, np.int64)
    previous[order[1:]] = order[:-1]
    place = np.arange(size)
    follows = np.zeros(size, bool)
    both = (previous[1:] > 0)
    follows[1:][both] = text[place[1:][both] - 1] == text[previous[1:][both] - 1]
    ask = np.flatnonzero(~follows & (previous >= 0))
    padded = np.concatenate([text, np.zeros(_PIECE, text.dtype)])
    pieces = np.lib.stride_tricks.sliding_window_view(padded, _PIECE)
    done = np.zeros(len(ask), np.int64)
    active = np.arange(len(ask))
    while len(active):
        x, y = ask[active] + done[active], previous[ask[active]] + done[active]
        unequal = pieces[np.minimum(x, size)] != pieces[np.minimum(y, size)]
        some = unequal.any(1)
        gain = np.where(some, unequal.argmax(1), _PIECE)
        # The end of the text ends a common prefix.
        gain = np.minimum(gain, size - np.maximum(x, y))
        done[active] += gain
        active = active[(gain == _PIECE)]
    out[ask] = done
    start = np.maximum.accumulate(np.where(~follows, place, 0))
    return np.where(previous >= 0, out[start] - (place - start), 0)


_PIECE = 32


def repeated(text: np.ndarray, length: int) -> np.ndarray:
    """Which places begin a string of so many bytes that begins at another place too."""
    order = suffix_array(text)
    shared = common_prefixes(text, order)
    found = shared >= length
    out = found.copy()
    before = np.full(len(text), -1, np.int64)
    before[order[1:]] = order[:-1]
    out[before[found]] = True
    return out
