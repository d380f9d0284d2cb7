"""Suffix arrays by induced sorting, and permuted common prefixes, on numpy arrays.

Suffixes are smaller (S) or larger (L) than their right neighbour. The leftmost smaller
ones (LMS) of each run are put in order first: induction sorts the pieces between them,
equal pieces get equal names, and the string of names is sorted by the same method. From
ordered LMS suffixes one scan upwards induces all L suffixes and one scan downwards all S.

A scan goes bucket by bucket (suffixes with the same first symbol): what a finished bucket
induces is appended to later buckets in one step, in order. Neighbouring buckets that
induce nothing into each other are taken together, so large alphabets cost few steps.
"""

from __future__ import annotations

import numpy as np

from murmur.llm.common import ship

ship(__name__)

NONE = -1
# Strings up to this length are sorted plainly.
SHORT = 32


def _types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its right neighbour; past the end is least of all."""
    n = len(t)
    smaller = np.zeros(n, bool)
    if n < 2:
        return smaller
    change = np.flatnonzero(t[:-1] != t[1:])
    rises = t[change] < t[change + 1]
    # A run of equal symbols takes the type of its last one.
    begins = np.concatenate([[0], change[:-1] + 1]) if len(change) else np.zeros(0, np.int64)
    if len(change):
        smaller[: change[-1] + 1] = np.repeat(rises, change - begins + 1)
    return smaller


def _append(sa: np.ndarray, pointer: np.ndarray, found: np.ndarray, symbol: np.ndarray, step: int) -> None:
    """Puts each of `found`, in order, at the pointer of its bucket, which moves by `step`."""
    if not len(found):
        return
    keys = symbol.astype(np.uint16) if len(pointer) <= 1 << 16 else symbol
    order = np.argsort(keys, kind="stable")
    bucket = symbol[order]
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    sizes = np.diff(np.concatenate([first, [len(bucket)]]))
    rank = np.arange(len(bucket)) - np.repeat(first, sizes)
    sa[pointer[bucket] + step * rank] = found[order]
    pointer[bucket[first]] += step * sizes


def _induce_larger(sa, t, smaller, edges) -> None:
    """Scan upwards: all L suffixes from the LMS suffixes that stand at the ends of buckets."""
    n, last = len(t), len(edges) - 1
    pointer = edges[:-1].copy()
    sa[pointer[t[-1]]] = n - 1
    pointer[t[-1]] += 1
    low, width = 0, 1
    while low < last:
        if edges[low] == edges[low + 1]:
            low = int(np.searchsorted(edges, edges[low], side="right")) - 1
            if low >= last:
                break
        high = min(low + width, last)
        held = sa[edges[low] : edges[high]]
        before = held[held > 0] - 1
        before = before[~smaller[before]]
        symbol = t[before]
        least = int(symbol.min()) if len(before) else high
        if least >= high:
            _append(sa, pointer, before, symbol, 1)
            low, width = high, width * 2
            continue
        if least > low:
            held = sa[edges[low] : edges[least]]
            before = held[held > 0] - 1
            before = before[~smaller[before]]
            _append(sa, pointer, before, t[before], 1)
            low, width = least, max(width // 2, 1)
            continue
        # The bucket feeds itself, by runs of its symbol: one step for each length of run.
        done, width = int(edges[low]), max(width // 2, 1)
        waves = []
        while done < pointer[low]:
            wave = sa[done : pointer[low]].copy()
            done += len(wave)
            before = wave[wave > 0] - 1
            before = before[~smaller[before]]
            own = before[t[before] == low]
            sa[pointer[low] : pointer[low] + len(own)] = own
            pointer[low] += len(own)
            waves.append(before[t[before] != low])
        rest = sa[pointer[low] : edges[low + 1]]
        before = rest[rest > 0] - 1
        waves.append(before[~smaller[before]])
        before = np.concatenate(waves)
        _append(sa, pointer, before, t[before], 1)
        low += 1


def _induce_smaller(sa, t, smaller, edges) -> None:
    """Scan downwards: all S suffixes from the L suffixes at the heads of buckets."""
    pointer = edges[1:] - 1
    high, width = len(edges) - 1, 1
    while high > 0:
        if edges[high] == edges[high - 1]:
            high = int(np.searchsorted(edges, edges[high], side="left"))
            if high <= 0:
                break
        low = max(high - width, 0)
        held = sa[edges[low] : edges[high]][::-1]
        before = held[held > 0] - 1
        before = before[smaller[before]]
        symbol = t[before]
        most = int(symbol.max()) if len(before) else low - 1
        if most < low:
            _append(sa, pointer, before, symbol, -1)
            high, width = low, width * 2
            continue
        if most < high - 1:
            held = sa[edges[most + 1] : edges[high]][::-1]
            before = held[held > 0] - 1
            before = before[smaller[before]]
            _append(sa, pointer, before, t[before], -1)
            high, width = most + 1, max(width // 2, 1)
            continue
        c = high - 1
        done, width = int(edges[high]) - 1, max(width // 2, 1)
        waves = []
        while done > pointer[c]:
            wave = sa[pointer[c] + 1 : done + 1][::-1].copy()
            done -= len(wave)
            before = wave[wave > 0] - 1
            before = before[smaller[before]]
            own = before[t[before] == c]
            sa[pointer[c] - len(own) + 1 : pointer[c] + 1] = own[::-1]
            pointer[c] -= len(own)
            waves.append(before[t[before] != c])
        rest = sa[edges[c] : pointer[c] + 1][::-1]
        before = rest[rest > 0] - 1
        waves.append(before[smaller[before]])
        before = np.concatenate(waves)
        _append(sa, pointer, before, t[before], -1)
        high -= 1


def _induced(t, smaller, edges, tails, lms) -> np.ndarray:
    """All suffixes, from LMS suffixes given in the order in which they are to stand."""
    sa = np.full(len(t), NONE, np.int64)
    # The last of a bucket is put first: ends of buckets are filled downwards.
    _append(sa, edges[1:] - 1, lms[::-1], t[lms[::-1]], -1)
    _induce_larger(sa, t, smaller, edges)
    sa[tails] = NONE
    _induce_smaller(sa, t, smaller, edges)
    return sa


def _names(t: np.ndarray, order: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For pieces in order: 0, 1, ..., the same for equal neighbours. ends[p]: last place of
    the piece that starts at p; the last piece, which runs past the end, equals no other."""
    sizes = ends[order] - order
    same = np.flatnonzero((sizes[1:] == sizes[:-1]) & (ends[order[1:]] < len(t)) & (ends[order[:-1]] < len(t)))
    equal = np.zeros(len(order) - 1, bool)
    at = 0
    while len(same):
        same = same[t[order[same] + at] == t[order[same + 1] + at]]
        over = sizes[same] == at
        equal[same[over]] = True
        same = same[~over]
        at += 1
    return np.concatenate([[0], np.cumsum(~equal)])


def suffix_array(t: np.ndarray, symbols: int) -> np.ndarray:
    """Starts of all suffixes of `t` (values 0 to symbols - 1) in ascending order."""
    n = len(t)
    t = t.astype(np.int64, copy=False)
    if n <= SHORT:
        plain = t.tolist()
        return np.array(sorted(range(n), key=lambda i: plain[i:]), np.int64)
    smaller = _types(t)
    edges = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=symbols))])
    # Places of S suffixes: the last ones of each bucket.
    count = np.bincount(t[smaller], minlength=symbols)
    tails = np.repeat(edges[1:] - np.cumsum(count), count) + np.arange(int(count.sum()))
    is_lms = np.zeros(n, bool)
    is_lms[1:] = smaller[1:] & ~smaller[:-1]
    lms = np.flatnonzero(is_lms)
    if len(lms) > 1:
        sa = _induced(t, smaller, edges, tails, lms)
        order = sa[is_lms[sa]]
        ends = np.full(n, n, np.int64)
        ends[lms[:-1]] = lms[1:]
        names = _names(t, order, ends)
        if names[-1] + 1 < len(lms):
            place = np.empty(n, np.int64)
            place[order] = names
            order = lms[suffix_array(place[lms], int(names[-1]) + 1)]
        lms = order
    return _induced(t, smaller, edges, tails, lms)


def permuted_prefixes(
    t: np.ndarray, sa: np.ndarray, starts: np.ndarray, counts: np.ndarray, most: int
) -> np.ndarray:
    """At place p: the symbols that suffix p has in common with the one before it in order,
    up to `most`; worked out for places starts[k] to starts[k] + counts[k] - 1, else 0.

    `most` symbols from each such place there is no 0 in `t`, which ends strings. In the
    order of the text a value is at least the one before it less 1, so each string goes on
    from where it was; strings advance side by side, one place at a time.
    """
    before = np.full(len(t), NONE, np.int64)
    before[sa[1:]] = sa[:-1]
    padded = np.concatenate([t, np.zeros(most + 1, t.dtype)])
    out = np.zeros(len(t), np.int64)
    order = np.argsort(-counts, kind="stable")
    starts, counts = starts[order], counts[order]
    length = np.zeros(len(starts), np.int64)
    for step in range(int(counts[0]) if len(counts) else 0):
        live = int(np.searchsorted(-counts, -step, side="left"))
        here = starts[:live] + step
        left = before[here]
        length = np.maximum(length[:live] - 1, 0)
        length[left < 0] = 0
        open_ = np.flatnonzero((left >= 0) & (length < most))
        while len(open_):
            at = length[open_]
            open_ = open_[padded[here[open_] + at] == padded[left[open_] + at]]
            length[open_] += 1
            open_ = open_[length[open_] < most]
        out[here] = length
    return out
