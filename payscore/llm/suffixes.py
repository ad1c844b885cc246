"""Suffix arrays of many short texts to a fixed depth, in numpy.

``order`` sorts all windows of ``depth`` bytes by Larsson and Sadakane's refinement: windows are
ranked by their first eight bytes, and only groups of equal ones are ranked again, by the ranks of
what follows, each time twice as deep. ``common_prefixes`` gives how far neighbours in that order
agree, by Kasai's rule in text order: where a window's neighbour is the one after the last window's
neighbour, all but one of the agreeing bytes are known to agree again.
"""

from __future__ import annotations

import numpy as np

_PAD = 16


def padded(data: np.ndarray) -> np.ndarray:
    return np.concatenate([data, np.zeros(_PAD, np.uint8)])


def _eight(data: np.ndarray, big: bool) -> np.ndarray:
    """The eight bytes from every place on, as one number; ``data`` is padded."""
    view = np.ndarray((len(data) - _PAD,), ">u8" if big else "<u8", data, strides=(1,))
    return view.astype(np.uint64)


def sorted_by(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A sorting order of unsigned numbers of ``bits`` bits, and the numbers in it."""
    places = max(len(keys) - 1, 1).bit_length()
    if bits + places > 64:
        by = np.argsort(keys)
        return by, keys[by]
    # Numbers that carry their places are sorted by value, much faster than places by numbers.
    both = (keys << np.uint64(places)) | np.arange(len(keys), dtype=np.uint64)
    both.sort()
    return (both & np.uint64((1 << places) - 1)).astype(np.int64), both >> np.uint64(places)


def _grouped(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A sorting order, and for each place in it the place where its group of equal keys starts."""
    by, keys = sorted_by(keys, bits)
    fresh = np.ones(len(keys), bool)
    fresh[1:] = keys[1:] != keys[:-1]
    return by, np.maximum.accumulate(np.where(fresh, np.arange(len(keys)), 0))


def order(data: np.ndarray, ends: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """The window starts sorted by their ``depth`` bytes.

    ``data`` is padded, ``ends`` is the end of the text around each place, and every window lies in
    its text. ``depth`` is 8 at least.
    """
    n = len(data) - _PAD
    left = ends - np.arange(n, dtype=np.int32)
    here = np.flatnonzero(left >= 8)
    rank = np.zeros(n, np.int32)
    by, group = _grouped(_eight(data, True)[here], 64)
    rank[here[by]] = group
    known = 8
    while known < depth:
        step = min(known, depth - known)
        if known + step == depth:
            here = starts
        else:
            here = here[left[here] >= known + step]
        # Only groups of more than one are refined.
        alone = np.bincount(rank[here], minlength=1)[rank[here]] == 1
        some = here[~alone]
        if len(some):
            wide = max(n - 1, 1).bit_length()
            keys = (rank[some].astype(np.uint64) << np.uint64(wide)) | rank[some + step].astype(np.uint64)
            by, group = _grouped(keys, 2 * wide)
            old = rank[some[by]]
            first = np.ones(len(old), bool)
            first[1:] = old[1:] != old[:-1]
            base = np.maximum.accumulate(np.where(first, np.arange(len(old)), 0))
            rank[some[by]] = old + (group - base)
        known += step
    return starts[sorted_by(rank[starts].astype(np.uint64), 32)[0]]


def common_prefixes(data: np.ndarray, sorted_starts: np.ndarray, depth: int) -> np.ndarray:
    """How many bytes, ``depth`` at most, each window shares with the one before it in the order."""
    n = len(data) - _PAD
    before = np.full(n + 1, -1, np.int64)
    before[sorted_starts[1:]] = sorted_starts[:-1]
    words = _eight(data, False)
    agree = np.zeros(n, np.int64)
    places = np.sort(sorted_starts)
    along = np.zeros(len(places), bool)
    along[1:] = (places[1:] == places[:-1] + 1) & (before[places[1:]] == before[places[:-1]] + 1) & (before[places[:-1]] >= 0)
    # Places where the neighbour does not move along are compared from the first byte.
    fresh = places[~along & (before[places] >= 0)]
    agree[fresh] = _extended(words, data, fresh, before[fresh], np.zeros(len(fresh), np.int64), depth)
    # The others follow from the place before them, run by run: all runs take one step at a time.
    step = np.arange(len(places)) - np.maximum.accumulate(np.where(~along, np.arange(len(places)), 0))
    by = np.argsort(step, kind="stable")
    cuts = np.searchsorted(step[by], np.arange(1, int(step.max(initial=0)) + 2))
    for a, b in zip(cuts, cuts[1:], strict=False):
        now = places[by[a:b]]
        known = np.maximum(agree[now - 1] - 1, 0)
        # Where bytes agreed up to some place below the depth, that place is the end again. After an
        # agreement of full depth, or of nothing, the end has to be looked for.
        deep = (agree[now - 1] == depth) | (agree[now - 1] == 0)
        agree[now] = known
        if deep.any():
            agree[now[deep]] = _extended(words, data, now[deep], before[now[deep]], known[deep], depth)
    return agree[sorted_starts]


def _extended(words: np.ndarray, data: np.ndarray, a: np.ndarray, b: np.ndarray, known: np.ndarray, depth: int) -> np.ndarray:
    """How far the bytes from ``a`` and from ``b`` on agree, given that ``known`` do."""
    known = known.copy()
    some = np.flatnonzero(known < depth)
    # Every window lies in its text, so places below the depth are places of the data.
    x, y = a[some] + known[some], b[some] + known[some]
    while len(some):
        differ = words[x] ^ words[y]
        # The bits below the lowest that differs; all 64 where none does.
        known[some] += np.bitwise_count(~differ & (differ - np.uint64(1))) >> 3
        more = (differ == 0) & (known[some] < depth)
        some, x, y = some[more], x[more] + 8, y[more] + 8
    return np.minimum(known, depth)
