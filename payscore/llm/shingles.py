"""Words and word shingles of whole batches of texts, as numpy arrays.

The texts of a batch are handled in chunks of whole documents of about ``CHUNK`` bytes. Word and
shingle hashes have 64 bits; sets are sets of these hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all others."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def chunks(column: pa.Array, start: int = 0) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole texts; a null text is empty."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    while start < len(column):
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + CHUNK, "right")) - 1)
        end = min(end, len(column))
        yield start, data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start]
        start = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and the number of words of each text; A-Z count as a-z."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    low = _LOWER[data]
    word = ~_SPACE[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    left = np.empty(n, bool)
    left[0] = True
    left[1:] = ~word[:-1]
    starts = np.flatnonzero(word & (left | first[:n]))
    right = np.empty(n, bool)
    right[-1] = True
    right[:-1] = ~word[1:]
    ends = np.flatnonzero(word & (right | first[1:])) + 1
    # A letter counts by a mixed number of itself and its place in the word, so no two words are alike by the form of a polynomial.
    begin = np.zeros(n, np.int64)
    begin[starts] = starts
    place = np.arange(n) - np.maximum.accumulate(begin)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mix((place.astype(np.uint64) << np.uint64(8) | low) + np.uint64(0x9E3779B97F4A7C15)), out=sums[1:])
    hashes = mix(sums[ends] - sums[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return hashes, np.diff(np.searchsorted(starts, offsets))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text in rising order, one text after the other, and their numbers.

    A text with fewer words than a shingle has one shingle, all of it; one without words has none.
    """
    words, counts = word_hashes(data, offsets)
    ends = np.cumsum(counts)
    starts = ends - counts
    docs = np.repeat(np.arange(len(counts)), counts)
    left = ends[docs] - np.arange(len(words))
    odd = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    total, used = np.zeros(len(words), np.uint64), np.minimum(left, size)
    for k in range(size):
        total += np.where(left > k, padded[k : k + len(words)] * odd[k], np.uint64(0))
    total = mix(total + used.astype(np.uint64))
    first = np.zeros(len(words), bool)
    first[starts[counts > 0]] = True
    keep = (left >= size) | first
    docs, total = docs[keep], total[keep]
    order = np.lexsort((total, docs))
    docs, total = docs[order], total[order]
    fresh = np.ones(len(docs), bool)
    fresh[1:] = (docs[1:] != docs[:-1]) | (total[1:] != total[:-1])
    return total[fresh], np.bincount(docs[fresh], minlength=len(counts))
