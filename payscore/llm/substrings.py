"""Removal of passages that stand in an earlier document, by suffix arrays over shards.

A byte goes if it is covered by a string of ``length`` bytes that also starts in a document with a
smaller id. Strings are judged on the input.

1. Whole documents are packed in shards of about ``shard_bytes``, written once.
2. Every window of ``length`` bytes has a mark: the least hash of the ``gram``-byte strings in it.
   Equal windows have equal marks, and neighbouring windows mostly share theirs, so a text is a few
   runs of windows with one mark. Marks that two documents share are found from sorted lists of marks,
   by ranges of marks. Only windows of shared marks can be repeats.
3. The bytes under those runs go to the range of their mark, each different run once per shard. There,
   runs whose mark another different run has are put in suffix arrays of bounded size (Larsson-Sadakane
   refinement, common prefixes by Kasai's rule); neighbours that agree in ``length`` bytes are one
   string, with the least id that has it. Arrays that hold runs of one mark are merged by binary search
   of one's strings in the others'.
4. Each shard gets back one bit for each window it sent, and removes what the windows cover.

Shards and ranges both grow with the input, so rows from every shard to every range would grow with
its square. From ``groups`` ranges on, one row and one group hold up to ``together`` neighbouring ranges,
which are worked on one after the other.

A mark with more than ``hot_runs`` runs (a common line with as many surroundings as documents) would
fill a range; its windows are sent one by one instead, each to the range of its own hash.

Nulls: a null text is empty. A null id counts as larger than all others, and rows with equal ids (or
with null ids) never remove anything from each other. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscore.llm import suffixes
from payscore.llm.common import table
from payscore.llm.shingles import mix
from payscore.shared import UNMEASURED, store

LAST = np.iinfo(np.int64).max
#: Windows whose marks are made at once, so that each pass over them stays in a core's cache.
BLOCK = 1 << 14
LOW = np.uint64(0xFFFFFFFF)


@dataclass(frozen=True)
class Passages:
    """Length of a repeated string, and sizes of the work."""

    length: int = 50
    gram: int = 20
    shard_bytes: int = 8 << 20
    #: Marks of one range, and bytes of one range of runs.
    range_marks: int = 1 << 19
    range_bytes: int = 2 << 20
    #: Ranges from which on rows hold several, and how many at most.
    groups: int = 1024
    together: int = 16
    array_bytes: int = 1 << 19
    hot_runs: int = 100_000
    #: Windows of one run, at most as many as bits of its answer.
    run_windows: int = 64
    #: Runs of a shard that are sent at once.
    sent_runs: int = 1 << 19


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), codec="zstd", asbytes=True)


def _unpacked(blob: bytes, count: int, kind: type) -> np.ndarray:
    size = count * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(blob, decompressed_size=size, codec="zstd"), kind) if size else np.zeros(0, kind)


_SHARDS = "shard long, ids array<long>, sizes array<long>, bytes long, data binary"


def _shards(rule: Passages, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents packed in shards; the number of a shard follows from its task."""
    shard = TaskContext.get().partitionId() << 32
    ids: list[int | None] = []
    texts: list[bytes] = []
    size = 0

    def made() -> pa.RecordBatch:
        nonlocal shard, ids, texts, size
        data = b"".join(texts)
        row = [
            pa.array([shard], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
            pa.array([len(data)], pa.int64()), pa.array([pa.compress(data, codec="zstd", asbytes=True)], pa.binary()),
        ]
        shard, ids, texts, size = shard + 1, [], [], 0
        return pa.RecordBatch.from_arrays(row, ["shard", "ids", "sizes", "bytes", "data"])

    for batch in batches:
        for key, text in zip(batch.column(0), batch.column(1).cast(pa.large_binary()), strict=True):
            ids.append(key.as_py())
            texts.append(text.as_py() or b"")
            size += len(texts[-1])
            if size >= rule.shard_bytes or len(texts) >= 100_000:
                yield made()
    if texts:
        yield made()


def _spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``counts`` places from each start on, one after the other."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))


def _heads(values: np.ndarray) -> np.ndarray:
    """Where sorted values change."""
    fresh = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=fresh[1:])
    return np.flatnonzero(fresh)


def _hashed(words: Iterable[np.ndarray]) -> np.ndarray:
    """A hash of strings, of eight bytes of each after the other."""
    h = shifted = None
    for w in words:
        if h is None:
            h = w * np.uint64(0x9E3779B97F4A7C15)
            shifted = np.empty_like(h)
            continue
        h ^= np.right_shift(h, np.uint64(29), out=shifted)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h += w
    h ^= np.right_shift(h, np.uint64(32), out=shifted)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= np.right_shift(h, np.uint64(29), out=shifted)
    return h


def _eights(width: int) -> list[int]:
    """Where eight bytes are taken from a string of ``width``."""
    return [*range(0, width - 8, 8), width - 8]


class Shard:
    """The texts of a shard and its runs: windows with one mark, as start, count, mark and document."""

    def __init__(self, rule: Passages, bits: int, ids: list, sizes: list, size: int, blob: bytes):
        self.rule, self.bits = rule, bits
        self.ids = np.array([LAST if x is None else x for x in ids], np.int64)
        self.null = np.array([x is None for x in ids], bool)
        self.offsets = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))])
        self.data = _unpacked(blob, size, np.uint8)
        windows = size - rule.length + 1
        if windows <= 0:
            self.starts = self.counts = self.docs = np.zeros(0, np.int64)
            self.marks = np.zeros(0, np.uint64)
            return
        starts, marks = self._runs(windows)
        docs = np.searchsorted(self.offsets, starts, "right") - 1
        # A run ends where the next one starts, or with the last window of its document.
        ends = np.minimum(np.append(starts[1:], windows), self.offsets[docs + 1] - rule.length + 1)
        whole = ends > starts
        starts, ends, docs = starts[whole], ends[whole], docs[whole]
        # Least hashes are small numbers; mixed once more they spread evenly over the ranges.
        marks = mix(marks[whole]) >> np.uint64(64 - bits)
        parts = -(-(ends - starts) // rule.run_windows)
        of = np.repeat(np.arange(len(starts)), parts)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
        self.starts = starts[of] + nth * rule.run_windows
        self.counts = np.minimum(ends[of] - self.starts, rule.run_windows)
        self.marks, self.docs = marks[of], docs[of]

    def _words(self) -> np.ndarray:
        data = suffixes.padded(self.data)
        return np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))

    def _runs(self, windows: int) -> tuple[np.ndarray, np.ndarray]:
        """Where a window has another mark than the one before it, or is the first of a document, and its mark."""
        rule, words = self.rule, self._words()
        reach, at = rule.length - rule.gram + 1, _eights(rule.gram)
        first = np.zeros(windows, bool)
        first[self.offsets[:-1][self.offsets[:-1] < windows]] = True
        starts, marks, last = [], [], np.uint64(0)
        for a in range(0, windows, BLOCK):
            n = min(BLOCK, windows - a) + reach - 1
            some = words[a : a + n + at[-1]].copy()
            h = _hashed(some[k : k + n] for k in at)
            # The least of `reach` values from every place on, by doubling.
            have = 1
            while have < reach:
                step = min(have, reach - have)
                h = np.minimum(h[:-step], h[step:])
                have += step
            fresh = first[a : a + len(h)]
            fresh[0] |= h[0] != last
            fresh[1:] |= h[1:] != h[:-1]
            last = h[-1]
            some = np.flatnonzero(fresh)
            starts.append(some + a)
            marks.append(h[some])
        return np.concatenate(starts), np.concatenate(marks)

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Marks in order, the mark of each run, the number of runs of a mark, and whether two ids have it."""
        by, marks = suffixes.sorted_by(self.marks, self.bits)
        heads = _heads(marks)
        counts = np.diff(np.append(heads, len(marks)))
        of = np.empty(len(marks), np.int64)
        of[by] = np.repeat(np.arange(len(heads)), counts)
        if not len(heads):
            return marks, of, counts, np.zeros(0, bool)
        ids = self.ids[self.docs[by]]
        return marks[heads], of, counts, np.minimum.reduceat(ids, heads) != np.maximum.reduceat(ids, heads)

    def chosen(self, shared: np.ndarray, hot: np.ndarray) -> Iterator[Chosen]:
        """The shared runs, and each window of hot ones as a run with a mark of its own, in blocks."""
        size = self.rule.sent_runs
        runs = np.flatnonzero(shared)
        for k in range(0, len(runs), size):
            some = runs[k : k + size]
            yield Chosen(self, self.starts[some], self.counts[some], self.docs[some], self.marks[some])
        runs = np.flatnonzero(hot)
        if not len(runs):
            return
        words, part = self._words(), (np.cumsum(self.counts[runs]) - 1) // size
        for some in np.split(runs, np.flatnonzero(np.diff(part)) + 1):
            starts = _spans(self.starts[some], self.counts[some])
            marks = mix(_hashed(words[starts + k] for k in _eights(self.rule.length))) >> np.uint64(64 - self.bits)
            yield Chosen(self, starts, np.ones(len(starts), np.int64), np.repeat(self.docs[some], self.counts[some]), marks)


class Chosen:
    """Runs of a shard, and the different byte strings among them in the order of their marks: which each run has, and their least ids."""

    def __init__(self, shard: Shard, starts: np.ndarray, counts: np.ndarray, docs: np.ndarray, marks: np.ndarray):
        self.starts, self.counts, self.ids = starts, counts, shard.ids[docs]
        self.begin, self.sizes = int(starts[0]), counts + (shard.rule.length - 1)
        self.raw = shard.data[self.begin : int(starts[-1] + self.sizes[-1])].tobytes()
        by, marks = suffixes.sorted_by(marks, shard.bits)
        heads = _heads(marks)
        each = np.diff(np.append(heads, len(by)))
        # Only runs of one mark can be equal.
        several = np.flatnonzero(np.repeat(each > 1, each))
        first = np.arange(len(by))
        put = {}.setdefault
        first[several] = [put(x, i) for x, i in zip(self._bytes(by[several]), several.tolist(), strict=True)]
        fresh = first == np.arange(len(by))
        self.of = np.empty(len(by), np.int64)
        self.of[by] = (np.cumsum(fresh) - 1)[first]
        self.runs, self.marks = by[fresh], marks[fresh]
        self.least = self.ids[self.runs]
        np.minimum.at(self.least, self.of[by[several]], self.ids[by[several]])

    def _bytes(self, runs: np.ndarray) -> list[bytes]:
        raw, starts = self.raw, self.starts[runs] - self.begin
        return [raw[a:b] for a, b in zip(starts.tolist(), (starts + self.sizes[runs]).tolist(), strict=True)]

    def strings(self) -> list[bytes]:
        return self._bytes(self.runs)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(len(batch)):
            yield {c: batch.column(i)[k].as_py() for i, c in enumerate(batch.schema.names)}


def _shard(rule: Passages, bits: int, row: dict) -> Shard:
    return Shard(rule, bits, row["ids"], row["sizes"], row["bytes"], row["data"])


def _by_group(marks: np.ndarray, bits: int, groups: int) -> Iterator[tuple[int, slice]]:
    """Runs of sorted marks that lie in one group of ranges."""
    if not len(marks):
        return
    of = (marks >> np.uint64(bits - groups)).astype(np.int64)
    cuts = _heads(of).tolist()
    for a, b in zip(cuts, [*cuts[1:], len(of)], strict=True):
        yield int(of[a]), slice(a, b)


def _by_range(marks: np.ndarray, bits: int, within: int) -> Iterator[np.ndarray]:
    """Where the marks of each range of a group of ranges are, by the ``bits`` low bits that marks of a group differ in."""
    if not within:
        yield np.arange(len(marks))
        return
    part = (marks >> np.uint32(bits - within)) & np.uint32((1 << within) - 1)
    for k in range(1 << within):
        some = np.flatnonzero(part == k)
        if len(some):
            yield some


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _listed(rule: Passages, bits: int, groups: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different marks of each shard, by group of ranges of marks."""
    for row in _rows(batches):
        marks, _, counts, _ = _shard(rule, bits, row).distinct()
        low, counts = (marks & LOW).astype(np.uint32), counts.astype(np.uint32)
        out = [(r, row["shard"], part.stop - part.start, _packed(low[part]), _packed(counts[part])) for r, part in _by_group(marks, bits, groups)]
        if out:
            yield _batch(out, _LISTED_ARROW)


_LISTED = "r long, shard long, n long, marks binary, counts binary"
_LISTED_ARROW = pa.schema([("r", pa.int64()), ("shard", pa.int64()), ("n", pa.int64()), ("marks", pa.binary()), ("counts", pa.binary())])
_FLAGS = "shard long, r long, n long, shared long, hot long, flags binary"
_FLAGS_ARROW = pa.schema([("shard", pa.int64()), ("r", pa.int64()), ("n", pa.int64()), ("shared", pa.int64()), ("hot", pa.int64()), ("flags", pa.binary())])


def _column(group: pa.Table, name: str, sizes: list[int], kind: type) -> np.ndarray:
    """The values of a column of packed arrays, one after the other."""
    return np.concatenate([_unpacked(b, n, kind) for b, n in zip(group.column(name).to_pylist(), sizes, strict=True)])


def _flagged(rule: Passages, bits: int, within: int, group: pa.Table) -> pa.Table:
    """For each shard's list of a group of ranges: 1 where another shard has the mark, 2 where it is hot as well."""
    sizes = group.column("n").to_pylist()
    marks = _column(group, "marks", sizes, np.uint32)
    counts = _column(group, "counts", sizes, np.uint32)
    flags = np.zeros(len(marks), np.uint8)
    for some in _by_range(marks, bits, within):
        by, sorted_marks = suffixes.sorted_by(marks[some].astype(np.uint64), 32)
        some = some[by]
        heads = _heads(sorted_marks)
        lists = np.diff(np.append(heads, len(some)))
        total = np.add.reduceat(counts[some], heads, dtype=np.int64)
        # Bit 1: in more than one shard. Bit 2: hot. What one shard alone knows is added there.
        flags[some] = np.repeat((lists > 1).astype(np.uint8) + 2 * (total > rule.hot_runs).astype(np.uint8), lists)
    first = np.cumsum(sizes) - sizes
    shared = np.add.reduceat(np.where(flags & 1, counts, 0), first, dtype=np.int64)
    hot = np.add.reduceat(np.where(flags > 1, counts, 0), first, dtype=np.int64)
    packed = [_packed(flags[a : a + n]) for a, n in zip(first.tolist(), sizes, strict=True)]
    columns = [group.column("shard"), group.column("r"), group.column("n"), pa.array(shared), pa.array(hot), pa.array(packed, pa.binary())]
    return pa.Table.from_arrays(columns, schema=_FLAGS_ARROW)


def _chosen(rule: Passages, bits: int, row: dict) -> tuple[Shard, Iterator[Chosen]]:
    """A shard, and blocks of its runs of shared marks."""
    shard = _shard(rule, bits, row)
    marks, of, _, own = shard.distinct()
    parts = sorted(row["flags"] or [], key=lambda x: x["r"])
    flags = np.concatenate([_unpacked(x["flags"], x["n"], np.uint8) for x in parts]) if parts else np.zeros(len(marks), np.uint8)
    shared, hot = (own | ((flags & 1) > 0))[of], (flags > 1)[of]
    return shard, shard.chosen(shared & ~hot, shared & hot)


_SENT = "q long, shard long, block long, n long, bytes long, marks binary, least binary, sizes binary, data binary"
_SENT_ARROW = pa.schema(
    [(x, pa.int64()) for x in ("q", "shard", "block", "n", "bytes")] + [(x, pa.binary()) for x in ("marks", "least", "sizes", "data")]
)


def _cut(rule: Passages, bits: int, groups: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different strings under the chosen runs of each shard, by group of ranges."""
    for row in _rows(batches):
        for block, runs in enumerate(_chosen(rule, bits, row)[1]):
            strings, sizes, low = runs.strings(), runs.sizes[runs.runs].astype(np.uint16), (runs.marks & LOW).astype(np.uint32)
            out = []
            for q, part in _by_group(runs.marks, bits, groups):
                data = b"".join(strings[part])
                n = part.stop - part.start
                out.append((q, row["shard"], block, n, len(data), _packed(low[part]), _packed(runs.least[part]), _packed(sizes[part]), pa.compress(data, codec="zstd", asbytes=True)))
            yield _batch(out, _SENT_ARROW)


def _array_of(rule: Passages, strings: list[bytes], least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array of some strings: for each window its group, and the groups' bytes and least ids in order."""
    sizes = np.array([len(s) for s in strings], np.int64)
    data = suffixes.padded(np.frombuffer(b"".join(strings), np.uint8))
    ends = np.cumsum(sizes)
    counts = sizes - rule.length + 1
    first = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(strings)), counts)
    starts = (ends - sizes)[text] + np.arange(int(counts.sum())) - first[text]
    del text
    by = suffixes.order(data, np.repeat(ends.astype(np.int32), sizes), starts, rule.length)
    agree = suffixes.common_prefixes(data, by, rule.length)
    fresh = agree < rule.length
    fresh[0] = True
    group = np.cumsum(fresh) - 1
    number = np.zeros(len(data), np.int64)
    number[by] = np.arange(len(by))
    owner = np.repeat(least, counts)
    window = np.zeros(len(data), np.int64)
    window[starts] = np.arange(len(starts))
    lowest = np.minimum.reduceat(owner[window[by]], np.flatnonzero(fresh))
    heads = by[fresh]
    keys = np.lib.stride_tricks.sliding_window_view(data, rule.length)[heads]
    keys = np.ascontiguousarray(keys).view(f"S{rule.length}").ravel()
    return group[number[starts]], keys, lowest


def _merged(arrays: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """The least id of each group of each array, over all arrays.

    Every array's strings are sorted, so they are found in the union of those before by binary search.
    """
    if len(arrays) == 1:
        return [arrays[0][2]]
    keys, lowest = arrays[0][1], arrays[0][2]
    for _, more, ids in arrays[1:]:
        at = np.minimum(np.searchsorted(keys, more), len(keys) - 1)
        known = keys[at] == more
        lowest = lowest.copy()
        lowest[at[known]] = np.minimum(lowest[at[known]], ids[known])
        place = np.searchsorted(keys, more[~known])
        keys, lowest = np.insert(keys, place, more[~known]), np.insert(lowest, place, ids[~known])
    return [lowest[np.searchsorted(keys, more)] for _, more, _ in arrays]


def _lowest(rule: Passages, strings: list[bytes], marks: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The least id that has each window of some different strings, with the strings' first windows and numbers of windows."""
    sizes = np.array([len(s) for s in strings], np.int64)
    counts = sizes - rule.length + 1
    first = np.cumsum(counts) - counts
    # Equal windows have equal marks: a string that is alone under its mark shares no window with another.
    lowest = np.repeat(ids, counts)
    by = np.argsort(marks, kind="stable")
    heads = _heads(marks[by])
    each = np.diff(np.append(heads, len(by)))
    by = by[np.repeat(each > 1, each)]
    each = each[each > 1]
    if not len(by):
        return lowest, first, counts
    heads = np.cumsum(each) - each
    size = np.add.reduceat(sizes[by], heads)

    def arrays(cuts: list[int], some: np.ndarray) -> Iterator[tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        for a, b in zip([0, *cuts], [*cuts, len(some)], strict=True):
            part = some[a:b]
            yield _spans(first[part], counts[part]), _array_of(rule, [strings[i] for i in part.tolist()], ids[part])

    def cuts(sizes: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // rule.array_bytes)) + 1

    # Arrays of bounded size: marks as a whole, and those that fill more than one array by themselves cut in several.
    large = size > rule.array_bytes
    whole = by[np.repeat(~large, each)]
    if len(whole):
        ends = np.cumsum(each[~large])
        for places, (groups, _, low) in arrays(ends[cuts(size[~large]) - 1].tolist(), whole):
            lowest[places] = low[groups]
    for a, n in zip(heads[large].tolist(), each[large].tolist(), strict=True):
        some = by[a : a + n]
        places, found = zip(*arrays(cuts(sizes[some]).tolist(), some), strict=True)
        for at, (groups, _, _), low in zip(places, found, _merged(list(found)), strict=True):
            lowest[at] = low[groups]
    return lowest, first, counts


def _full(counts: np.ndarray) -> np.ndarray:
    """A bit for each of some windows."""
    return np.uint64(0xFFFFFFFFFFFFFFFF) >> (64 - counts).astype(np.uint64)


_ANSWER = "shard long, block long, q long, n long, bits binary"
_ANSWER_ARROW = pa.schema([(x, pa.int64()) for x in ("shard", "block", "q", "n")] + [("bits", pa.binary())])


def _answered(rule: Passages, bits: int, within: int, group: pa.Table) -> pa.Table:
    """For each string a shard sent, a bit for each window: does a smaller id than the shard's least have it?"""
    n = group.column("n").to_pylist()
    marks, sizes = _column(group, "marks", n, np.uint32), _column(group, "sizes", n, np.uint16).astype(np.int64)
    least = _column(group, "least", n, np.int64)
    data = b"".join(
        pa.decompress(x, decompressed_size=size, codec="zstd", asbytes=True) for x, size in zip(group.column("data").to_pylist(), group.column("bytes").to_pylist(), strict=True)
    )
    ends = np.cumsum(sizes)
    bits = np.zeros(len(marks), np.uint64)
    for some in _by_range(marks, bits, within):
        seen: dict[bytes, int] = {}
        put = seen.setdefault
        of = np.array([put(data[a:b], len(seen)) for a, b in zip((ends - sizes)[some].tolist(), ends[some].tolist(), strict=True)], np.int64)
        ids, mark, mine = np.full(len(seen), LAST), np.zeros(len(seen), np.uint32), least[some]
        np.minimum.at(ids, of, mine)
        mark[of] = marks[some]
        lowest, first, counts = _lowest(rule, list(seen), mark, ids)
        # Most strings have all their windows from one document.
        low, high = np.minimum.reduceat(lowest, first)[of], np.maximum.reduceat(lowest, first)[of]
        found = np.where(high < mine, _full(counts[of]), np.uint64(0))
        mixed = np.flatnonzero((low < mine) & (high >= mine))
        part = of[mixed]
        text, step = np.repeat(mixed, counts[part]), _spans(np.zeros(len(part), np.int64), counts[part])
        earlier = lowest[_spans(first[part], counts[part])] < mine[text]
        np.bitwise_or.at(found, text[earlier], np.uint64(1) << step[earlier].astype(np.uint64))
        bits[some] = found
    packed = [_packed(bits[b - x : b]) for b, x in zip(np.cumsum(n).tolist(), n, strict=True)]
    return pa.Table.from_arrays([*(group.column(c) for c in _ANSWER_ARROW.names[:-1]), pa.array(packed, pa.binary())], schema=_ANSWER_ARROW)


def _applied(rule: Passages, bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the text that is kept, of each document."""
    for row in _rows(batches):
        shard, blocks = _chosen(rule, bits, row)
        gone = np.zeros(len(shard.data) + 1, np.int32)
        answers: dict[int, list[dict]] = {}
        for x in sorted(row["answers"] or [], key=lambda x: x["q"]):
            answers.setdefault(x["block"], []).append(x)
        for block, runs in enumerate(blocks):
            found = np.concatenate([_unpacked(x["bits"], x["n"], np.uint64) for x in answers[block]])
            # A later document of this shard has every string of a run from the first one that has it.
            full = _full(runs.counts)
            take = np.where(runs.ids > runs.least[runs.of], full, found[runs.of])
            whole = take == full
            np.add.at(gone, runs.starts[whole], 1)
            np.add.at(gone, runs.starts[whole] + runs.counts[whole] + (rule.length - 1), -1)
            some = np.flatnonzero((take > 0) & ~whole)
            text, step = np.repeat(some, runs.counts[some]), _spans(np.zeros(len(some), np.int64), runs.counts[some])
            starts = (runs.starts[text] + step)[(take[text] >> step.astype(np.uint64)) & np.uint64(1) > 0]
            np.add.at(gone, starts, 1)
            np.add.at(gone, starts + rule.length, -1)
        covered = np.cumsum(gone[:-1], dtype=np.int32) > 0
        rows = []
        for i in range(len(shard.ids)):
            a, b = shard.offsets[i], shard.offsets[i + 1]
            cover = covered[a:b]
            kept = shard.data[a:b][~cover].tobytes()
            spans = int(cover[:1].sum() + (cover[1:] & ~cover[:-1]).sum())
            rows.append((None if shard.null[i] else int(shard.ids[i]), int(b - a), int(cover.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
        yield _batch(rows, _KEPT_ARROW)


_KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
_KEPT_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())]
)


def _bits_for(total: float, each: int) -> int:
    return max(0, int(np.ceil(np.log2(max(total / each, 1)))))


def _grouped_bits(rule: Passages, ranges: int) -> int:
    """The groups of so many ranges, both as powers of two."""
    return min(ranges, max(int(np.log2(rule.groups)), ranges - int(np.log2(rule.together))))


def without_repeats(docs: DataFrame, rule: Passages = Passages()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes of each document."""
    shards = store(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(lambda b: _shards(rule, b), _SHARDS), UNMEASURED
    ).df
    size = shards.agg(F.sum("bytes")).first()[0] or 0
    # About two marks in a window's length of grams are least ones.
    ranges = _bits_for(2 * size / (rule.length - rule.gram + 1), rule.range_marks)
    groups = _grouped_bits(rule, ranges)
    bits = groups + 32
    listed = shards.mapInArrow(lambda b: _listed(rule, bits, groups, b), _LISTED)
    flags = store(listed.groupBy("r").applyInArrow(lambda t: _flagged(rule, 32, ranges - groups, t), _FLAGS), UNMEASURED).df
    sums = flags.agg(F.sum("shared").alias("shared"), F.sum("hot").alias("hot")).first()
    per_shard = flags.groupBy(F.col("shard").alias("s")).agg(F.collect_list(F.struct("r", "n", "flags")).alias("flags"))
    known = shards.join(per_shard, F.col("s") == F.col("shard"), "left").drop("s")
    # A hot run is sent window by window.
    sent_bytes = (sums["shared"] or 0) * (rule.length + 15) + (sums["hot"] or 0) * rule.length * 15
    spread = min(bits, _bits_for(sent_bytes, rule.range_bytes))
    heaps = _grouped_bits(rule, spread)
    low = min(32, bits - heaps)
    inside = min(low, spread - heaps)
    sent = known.mapInArrow(lambda b: _cut(rule, bits, heaps, b), _SENT)
    # Not stored: in one plan, the texts that are cut and those that answers are applied to come from one exchange.
    answers = sent.groupBy("q").applyInArrow(lambda t: _answered(rule, low, inside, t), _ANSWER)
    back = answers.groupBy(F.col("shard").alias("s")).agg(F.collect_list(F.struct("block", "q", "n", "bits")).alias("answers"))
    known = known.join(back, F.col("s") == F.col("shard"), "left").drop("s")
    return known.mapInArrow(lambda b: _applied(rule, bits, b), _KEPT)


def op3_substrings(spark, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).drop("kept")
