"""Near-duplicate documents by an LSH forest over MinHash signatures.

1. Texts with equal shingle sets are one class, found by a fingerprint of the set.
2. Each class gets ``trees`` labels of ``depth`` MinHash values. In each tree all classes are sorted
   by label, in ranges over the cluster, so no group of alike documents has to fit one task.
3. Neighbours in the sorted order that share at least ``shallow`` leading values are candidates. In a
   sparse region that is everything near; in a dense one the neighbours in the order are those with
   the longest common prefix, so the depth in use follows the region.
4. First every class is compared with its nearest neighbour only, on the full sets, and the confirmed
   pairs are joined to components. Then each class is compared with its best neighbour in another
   component among the ``near`` next places, and then with more and more of all that share ``shallow``
   leading values with it in any tree, best agreement of signatures first and as few for every two
   components, until no candidate is left uncompared. Regions of more than ``block_rows`` classes are cut into blocks, and every two blocks
   meet in a task. Texts that are linked already are not compared.

One byte of each value of the signature lets candidates pass that could be similar enough; every link is
confirmed on full sets of 64-bit shingle hashes. A pair at the threshold shares three leading values
in one tree with probability 0.51, and in none of 16 trees with 0.00001.

Nulls: a null text is empty; texts without words are linked with nothing. A row with a null id can be
linked but never names a component; a class of such rows alone has a null component. Repeated rows
are one class. Rows with equal ids are judged each by its own text. An empty table gives an empty
result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscore.llm.common import table, unpack, with_row
from payscore.llm.components import TASK_ROWS, components
from payscore.llm.shingles import chunks, mix, shingle_sets
from payscore.shared import UNMEASURED, Stored, lookup, store


@dataclass(frozen=True)
class Forest:
    """Shape of the forest, and what counts as near: ``percent`` of the union is shared."""

    shingle: int = 5
    percent: int = 80
    trees: int = 16
    depth: int = 6
    shallow: int = 3
    near: int = 16
    #: Classes of one block of a region.
    block_rows: int = 1024
    #: A block of ``crowd_rows`` or more with over ``crowd_pairs`` candidates for each row is compared as a whole.
    crowd_rows: int = 64
    crowd_pairs: int = 4
    #: Shingles of one block of such a region.
    block_shingles: int = 4_000_000
    #: Candidates that agree in a smaller part of their values are too far apart (at 80 percent, one in 100,000 is).
    least_agreement: float = 0.62
    #: Rows of one range of a sorted order.
    range_rows: int = 200_000

    @property
    def values(self) -> int:
        return self.trees * self.depth


def _signatures(sets: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """``n`` MinHash values of 32 bits for each set; sets must not be empty."""
    starts = np.cumsum(counts) - counts
    seeds = mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
    out = np.empty((len(counts), n), np.uint32)
    for k in range(n):
        # The high half of a product depends on all bits of a well mixed hash.
        out[:, k] = np.minimum.reduceat(((sets ^ (seeds[k] >> np.uint64(7))) * seeds[k]) >> np.uint64(32), starts).astype(np.uint32)
    return out


def _fingerprints(sets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    starts = np.cumsum(counts) - counts
    return mix(np.add.reduceat(mix(sets ^ np.uint64(0x5851F42D4C957F2D)), starts) + counts.astype(np.uint64)).view(np.int64)


def _read(rule: Forest, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, n_shingles, class (null without words) and signature of each text."""
    for batch in batches:
        for start, data, offsets in chunks(batch.column(1)):
            sets, counts = shingle_sets(data, offsets, rule.shingle)
            full = counts > 0
            node = np.zeros(len(counts), np.int64)
            blobs: list[bytes | None] = [None] * len(counts)
            if full.any():
                node[full] = _fingerprints(sets, counts[full])
                for i, row in zip(np.flatnonzero(full), _signatures(sets, counts[full], rule.values).astype(">u4"), strict=True):
                    blobs[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(start, len(counts)),
                    pa.array(counts, pa.int64()),
                    pa.array(node, pa.int64(), mask=~full),
                    pa.array(blobs, pa.binary()),
                ],
                ["doc_id", "n_shingles", "node", "signature"],
            )


def _labels(rule: Forest, sketched: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per tree: tree, label, node, root, n_shingles, and the lowest byte of every value as sketch."""
    for batch in batches:
        if not len(batch):
            continue
        values = np.frombuffer(b"".join(batch.column(3).to_pylist()), ">u4").reshape(len(batch), rule.values)
        bytes_ = (values.astype(np.uint32) & np.uint32(255)).astype(np.uint8)
        sketches = pa.array([x.tobytes() if sketched else b"" for x in bytes_], pa.binary())
        for t in range(rule.trees):
            part = np.ascontiguousarray(values[:, t * rule.depth : (t + 1) * rule.depth])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(batch), t, np.int32)), pa.array([x.tobytes() for x in part], pa.binary()),
                    batch.column(0), batch.column(1), batch.column(2), sketches,
                ],
                ["tree", "label", "node", "root", "n", "sketch"],
            )


_ORDERED = "tree int, label binary, node long, root long, n long, sketch binary"


def _neighbours(rule: Forest, reach: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best pair (a, b, value) of each row of a sorted range, of rows at most ``reach`` places apart.

    Pairs within a component or of sketches too different are left out; pairs of sizes too different
    have value -1, and so have the first and the last row of a range with themselves, as a region may
    go on in the next range.
    """
    tail: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if tail is None and len(rows):
            yield _alone(rows.column("node")[0].as_py())
        if tail is not None:
            rows = pa.concat_tables([tail, rows])
        old = 0 if tail is None else len(tail)
        if not len(rows):
            continue
        tail = rows.slice(max(0, len(rows) - reach))
        rows = rows.combine_chunks()
        n = len(rows)
        tree, node, root, size = (rows.column(c).to_numpy() for c in ("tree", "node", "root", "n"))
        labels = np.frombuffer(b"".join(rows.column("label").to_pylist()), ">u4").reshape(n, rule.depth).astype(np.uint32)
        sketches = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(n, -1)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        i = np.arange(n)
        for j in range(1, min(reach, n - 1) + 1):
            # Rows are sorted: where a region ends before the j-th place, it does so for every later one.
            i = i[i < n - j]
            i = i[(tree[i] == tree[i + j]) & (labels[i, : rule.shallow] == labels[i + j, : rule.shallow]).all(axis=1)]
            if not len(i):
                break
            k = i[(i + j >= old) & (root[i] != root[i + j])]
            agree = (sketches[k] == sketches[k + j]).sum(axis=1)
            if sketches.shape[1]:
                good = agree >= rule.least_agreement * rule.values
                k, agree = k[good], agree[good]
            if not len(k):
                continue
            shared = np.cumprod(labels[k] == labels[k + j], axis=1).sum(axis=1)
            value = np.where(_sizes_fit(rule, size[k], size[k + j]), agree * (rule.depth + 1) + shared, -1)
            found += [(k, k + j, value), (k + j, k, value)]
        if found:
            here, there, value, _ = _best(found, 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[here]), pa.array(node[there]), pa.array(value.astype(np.int32))], ["a", "b", "value"]
            )
    if tail is not None:
        yield _alone(tail.column("node")[-1].as_py())


def _alone(node: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([node], pa.int64()), pa.array([-1], pa.int32())], ["a", "b", "value"])


def _sizes_fit(rule: Forest, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return 100 * np.minimum(x, y) >= rule.percent * np.maximum(x, y)


_REGIONS = "region long, tree int, node long, root long, n long, sketch binary, regions binary"


def _regions(rule: Forest, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per tree: region (a hash of the tree and the leading values), tree, node, root, n_shingles, sketch, and the regions in all trees."""
    for batch in batches:
        if not len(batch):
            continue
        values = np.frombuffer(b"".join(batch.column(3).to_pylist()), ">u4").reshape(len(batch), rule.trees, rule.depth).astype(np.uint64)
        region = np.broadcast_to(mix(np.arange(rule.trees, dtype=np.uint64)), (len(batch), rule.trees))
        for k in range(rule.shallow):
            region = mix(region * np.uint64(3) + values[:, :, k])
        sketches = pa.array([x.tobytes() for x in (values.reshape(len(batch), -1) & np.uint64(255)).astype(np.uint8)], pa.binary())
        regions = pa.array([x.tobytes() for x in region], pa.binary())
        for t in range(rule.trees):
            own = pa.array(np.ascontiguousarray(region[:, t]).view(np.int64))
            tree = pa.array(np.full(len(batch), t, np.int32))
            yield pa.RecordBatch.from_arrays([own, tree, *batch.columns[:3], sketches, regions], ["region", "tree", "node", "root", "n", "sketch", "regions"])


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows, sorted by region and pair, cut where a block ends."""
    held: pa.Table | None = None
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        if held is None or not len(held):
            continue
        region, pair = held.column("region").to_numpy(), held.column("pair").to_numpy()
        # The last block may go on in the next batch.
        ends = len(held)
        if batch is not None:
            other = np.flatnonzero((region != region[-1]) | (pair != pair[-1]))
            ends = int(other[-1]) + 1 if len(other) else 0
        rows, held = held.slice(0, ends).combine_chunks(), held.slice(ends)
        if ends:
            yield rows


def _alike(rule: Forest, rows: pa.Table, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Candidates (here, there, value) of whole blocks: rows in different components, near enough in size and sketch.

    Rows come sorted by block and root, ``starts`` are where blocks start. A pair belongs to the first tree in which
    both are in one region, and to no other.
    """
    side, root, size = (rows.column(c).to_numpy() for c in ("side", "root", "n"))
    sketches = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(len(rows), rule.values)
    regions = np.frombuffer(b"".join(rows.column("regions").to_pylist()), np.uint64).reshape(len(rows), rule.trees)
    earlier = np.arange(rule.trees) < rows.column("tree").to_numpy()[:, None]

    def ends(fresh: np.ndarray) -> np.ndarray:
        """For each row, where its run ends."""
        cuts = np.flatnonzero(np.concatenate([[True], fresh, [True]]))
        return np.repeat(cuts[1:], np.diff(cuts))

    new_block = np.zeros(len(rows), bool)
    new_block[starts] = True
    new_block = new_block[1:]
    block_end, root_end = ends(new_block), ends(new_block | (root[1:] != root[:-1]))
    partners = block_end - root_end
    some = np.flatnonzero(partners)
    # About 200,000 pairs at a time.
    cuts = np.searchsorted(np.cumsum(partners[some]), np.arange(200_000, partners.sum() + 200_000, 200_000))
    for i in np.split(some, np.unique(cuts[cuts < len(some)])):
        here = np.repeat(i, partners[i])
        there = np.arange(len(here)) - np.repeat(np.cumsum(partners[i]) - partners[i], partners[i]) + np.repeat(root_end[i], partners[i])
        good = _sizes_fit(rule, size[here], size[there]) & ((side[here] < 0) | (side[here] != side[there]))
        here, there = here[good], there[good]
        value = (sketches[here] == sketches[there]).sum(axis=1)
        good = value >= rule.least_agreement * rule.values
        here, there, value = here[good], there[good], value[good]
        first = ~((regions[here] == regions[there]) & earlier[here]).any(axis=1)
        yield here[first], there[first], value[first]


def _block_starts(rows: pa.Table) -> np.ndarray:
    region, pair = rows.column("region").to_numpy(), rows.column("pair").to_numpy()
    return np.flatnonzero(np.concatenate([[True], (region[1:] != region[:-1]) | (pair[1:] != pair[:-1])]))


def _meetings(rule: Forest, last: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, more) of the candidates of each block. A crowded block gives none but its region as a, without b.

    Every two components give their ``last`` best pairs, and each row of these its ``last`` best, each pair
    once with the lesser node as a; ``more`` tells that a had others, and both rows of a pair that is left out say so. A
    row that is the lesser of none gives a pair with itself.
    """
    for rows in _whole_blocks(batches):
        yield from _met(rule, last, rows)


def _met(rule: Forest, last: int, rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """The pairs of whole blocks."""
    region, node, root = (rows.column(c).to_numpy() for c in ("region", "node", "root"))
    starts = _block_starts(rows)
    sizes = np.diff(np.concatenate([starts, [len(rows)]]))
    block = np.repeat(np.arange(len(starts)), sizes)
    seen, crowded = np.zeros(len(starts), np.int64), np.zeros(len(starts), bool)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    many = 0

    def ranked() -> Iterator[pa.RecordBatch]:
        kept = [tuple(x[~crowded[block[c[0]]]] for x in c) for c in found]
        if sum(len(c[0]) for c in kept):
            yield _ranked(kept, last, node, root)

    for pairs in _alike(rule, rows, starts):
        seen += np.bincount(block[pairs[0]], minlength=len(starts))
        crowded = (sizes >= rule.crowd_rows) & (seen > rule.crowd_pairs * sizes)
        found.append(pairs)
        many += len(pairs[0])
        if many > 500_000:
            yield from ranked()
            found, many = [], 0
    yield from ranked()
    if crowded.any():
        full = np.unique(region[starts[crowded]])
        none = pa.nulls(len(full))
        yield pa.RecordBatch.from_arrays([pa.array(full), none.cast(pa.int64()), none.cast(pa.bool_())], ["a", "b", "more"])


def _linked_within(rule: Forest, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) that join the components of each block as far as its candidates are near on full sets."""
    for rows in _whole_blocks(batches):
        starts = _block_starts(rows)
        for start, stop in zip(starts, [*starts[1:], len(rows)], strict=True):
            a, b = _spanned(rule, rows.slice(start, stop - start).combine_chunks())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _spanned(rule: Forest, rows: pa.Table) -> tuple[list[int], list[int]]:
    """The links of one block. Texts in one component already, also by a link found here, are not compared."""
    node = rows.column("node").to_numpy()
    parts = [(data, offsets) for chunk in rows.column("text").chunks for _, data, offsets in chunks(chunk)]
    read = [shingle_sets(data, offsets, rule.shingle) for data, offsets in parts]
    counts = np.concatenate([c for _, c in read])
    values, ids = np.unique(np.concatenate([v for v, _ in read]), return_inverse=True)
    ends = np.cumsum(counts)
    sets = np.split(ids, ends[:-1])
    own = np.unique(rows.column("root").to_numpy(), return_inverse=True)[1]
    mark = np.zeros(len(values), bool)
    a: list[int] = []
    b: list[int] = []
    for here, there, _ in _alike(rule, rows, np.zeros(1, np.int64)):
        # All pairs of a row are together.
        cuts = np.flatnonzero(np.concatenate([[True], here[1:] != here[:-1]])) if len(here) else []
        for i, others in zip(here[cuts], np.split(there, cuts[1:]), strict=True) if len(here) else ():
            others = others[(own[others] != own[i]) & (counts[others] > 0)]
            if not len(others):
                continue
            mark[sets[i]] = True
            both = np.add.reduceat(mark[np.concatenate([sets[k] for k in others])], np.cumsum(counts[others]) - counts[others], dtype=np.int64)
            mark[sets[i]] = False
            near = others[(100 * both >= rule.percent * (counts[i] + counts[others] - both)) & (both > 0)]
            met, first = np.unique(own[near], return_index=True)
            if len(met):
                a += [int(node[i])] * len(met)
                b += node[near[first]].tolist()
                own[np.isin(own, met)] = own[i]
    return a, b


def _ranked(
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], last: int, node: np.ndarray, root: np.ndarray
) -> pa.RecordBatch:
    """The ``last`` best pairs of every two components, and of these the ``last`` best of each row.

    One confirmed pair of two components spares all others of them. A row that had more pairs says so, by
    a pair with itself if it is the lesser node of none.
    """
    here, there, value = (np.concatenate(x) for x in zip(*found, strict=True))
    by = np.lexsort((there, here, -value, root[there], root[here]))
    here, there, value = here[by], there[by], value[by]
    fresh = np.concatenate([[True], (root[here[1:]] != root[here[:-1]]) | (root[there[1:]] != root[there[:-1]])])
    starts = np.flatnonzero(fresh)
    keep = np.arange(len(here)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(here)]]))) < last
    waiting = np.unique(node[np.concatenate([here[~keep], there[~keep]])])
    here, there, value = here[keep], there[keep], value[keep]
    here, there, _, more = _best([(here, there, value), (there, here, value)], last)
    waiting = np.union1d(waiting, node[here[more]])
    a, b = np.minimum(node[here], node[there]), np.maximum(node[here], node[there])
    by = np.lexsort((b, a))
    a, b = a[by], b[by]
    fresh = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    a, b = a[fresh], b[fresh]
    alone = np.setdiff1d(waiting, a)
    more = np.concatenate([np.isin(a, waiting), np.ones(len(alone), bool)])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([a, alone])), pa.array(np.concatenate([b, alone])), pa.array(more)], ["a", "b", "more"]
    )


def _best(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each row its ``last`` best pairs, and whether it has others."""
    here, there, value = (np.concatenate(x) for x in zip(*found, strict=True))
    by = np.lexsort((there, -value, here))
    here, there, value = here[by], there[by], value[by]
    starts = np.flatnonzero(np.concatenate([[True], here[1:] != here[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(here)]]))
    keep = np.arange(len(here)) - np.repeat(starts, sizes) < last
    return here[keep], there[keep], value[keep], np.repeat(sizes > last, sizes)[keep]


def _confirm(rule: Forest, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) whose full sets are near enough, from rows a, b, text of a, text of b."""
    for batch in batches:
        good = np.zeros(len(batch), bool)
        for k in range(0, len(batch), 64):
            some = batch.slice(k, 64)
            sides = []
            for c in (2, 3):
                sets: list[np.ndarray] = []
                for _, data, offsets in chunks(some.column(c)):
                    values, counts = shingle_sets(data, offsets, rule.shingle)
                    sets += np.split(values, np.cumsum(counts)[:-1])
                sides.append(sets)
            for i, (x, y) in enumerate(zip(*sides, strict=True)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                good[k + i] = 100 * both >= rule.percent * (len(x) + len(y) - both) and both > 0
        yield batch.select([0, 1]).filter(pa.array(good))


def classes(docs: DataFrame, rule: Forest) -> DataFrame:
    """doc_id, n_shingles, node, signature for each row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_shingles long, node long, signature binary"
    return docs.select("doc_id", "text").mapInArrow(lambda batches: _read(rule, batches), schema)


def linked(docs: DataFrame, rule: Forest = Forest()) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, node) of all rows, and (node, component) of the nodes with words.

    ``component`` is the least id of all documents linked, directly or through others.
    """
    rows = store(classes(docs, rule), UNMEASURED).df
    members = rows.select("doc_id", "n_shingles", "node")
    met = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"), F.min("signature").alias("signature"), F.min("n_shingles").alias("n"))
    nodes = store(met, UNMEASURED)
    roots, done, texts, crowded = None, None, None, None
    active, ranges = nodes, max(1, -(-nodes.rows * rule.trees // rule.range_rows))
    nodes = nodes.df
    for turn in itertools.count():
        # First the nearest neighbour of each class, then its best ones in other components: one of
        # those near, then more and more of all in the region, until no class has others.
        given = active.df.select("node", F.col("node").alias("root"), "n", "signature")
        if roots is not None:
            given = active.df.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "n", "signature")
        if turn < 2:
            near = store(_candidates(given, rule, ranges, (1, rule.near)[turn], turn > 0), UNMEASURED)
            pairs = near.df.where("value >= 0").groupBy("a").agg(F.max_by("b", F.struct("value", "b")).alias("b"))
        else:
            near = store(_all_candidates(given, rule, 4 ** (turn - 1), crowded), UNMEASURED)
            pairs = near.df.where("a <> b")
        if turn == 0:
            # Only classes that share a label with another can be linked, now or later.
            some = near.df.select(F.explode(F.array("a", "b")).alias("node")).distinct()
            active = store(active.df.join(some, "node", "left_semi"), UNMEASURED)
            ranges = max(1, -(-active.rows * rule.trees // rule.range_rows))
            texts = store(_texts_of(docs, rows, active.df), UNMEASURED).df
        elif turn > 1:
            # Both classes of a pair that was left out have more.
            active = store(active.df.join(near.df.where("more").select(F.col("a").alias("node")).distinct(), "node", "left_semi"), UNMEASURED)
        tasks = 4 + near.rows // TASK_ROWS
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().coalesce(tasks)
        pairs = store(pairs if done is None else pairs.join(done, ["a", "b"], "left_anti").coalesce(tasks), UNMEASURED)
        done = pairs.df if done is None else done.unionAll(pairs.df)
        new = None
        if pairs.rows:
            sides = [texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab"]
            full = pairs.df.join(sides[0], "a").join(sides[1], "b").select("a", "b", "text_a", "text_b")
            new = store(full.mapInArrow(lambda batches: _confirm(rule, batches), "a long, b long"), UNMEASURED)
        if new is not None and new.rows:
            roots = store(_joined(new.df, roots), UNMEASURED).df
        if turn > 1:
            full = store(near.df.where("b IS NULL").select(F.col("a").alias("crowded")).distinct(), 24)
            if full.rows:
                # All pairs of these regions are settled now, so later turns leave them out.
                new = store(_crowds(given, rule, full, texts), UNMEASURED)
                crowded = full if crowded is None else store(crowded.df.unionAll(full.df), 24)
                if new.rows:
                    roots = store(_joined(new.df, roots), UNMEASURED).df
        if turn > 0 and not active.rows:
            break
    if roots is None:
        roots = nodes.select("node", F.col("node").alias("root"))
    both = nodes.select("node", "least").join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    least = both.groupBy("root").agg(F.min("least").alias("component"))
    return members, both.join(least, "root").select("node", "component")


def _joined(links: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(node, root) after new links: components of the components that they touch."""
    if roots is None:
        return components(links)
    for c in "ab":
        at = roots.select(F.col("node").alias(f"node_{c}"), F.col("root").alias(f"root_{c}"))
        links = links.join(at, F.col(f"node_{c}") == F.col(c), "left").withColumn(c, F.coalesce(f"root_{c}", c)).select("a", "b")
    met = components(links).withColumnsRenamed({"node": "old", "root": "new"})
    moved = roots.join(met, F.col("old") == F.col("root"), "left").select("node", F.coalesce("new", "root").alias("root"))
    # Nodes that had no link before are their own old root.
    fresh = met.join(roots.select("node"), F.col("old") == F.col("node"), "left_anti").select(F.col("old").alias("node"), F.col("new").alias("root"))
    return moved.unionAll(fresh)


def _candidates(given: DataFrame, rule: Forest, ranges: int, reach: int, sketched: bool) -> DataFrame:
    """Pairs of near rows in any of the sorted orders of (node, root, n, signature)."""
    order = given.mapInArrow(lambda batches: _labels(rule, sketched, batches), _ORDERED)
    # Equal labels are in another order in each tree.
    order = order.withColumn("tie", F.xxhash64("tree", "node"))
    order = order.repartitionByRange(ranges, "tree", "label", "tie").sortWithinPartitions("tree", "label", "tie")
    return order.drop("tie").mapInArrow(lambda batches: _neighbours(rule, reach, batches), "a long, b long, value int")


def _all_candidates(given: DataFrame, rule: Forest, last: int, crowded: Stored | None) -> DataFrame:
    """For each of (node, root, n, signature) the ``last`` best of all that share leading values with it in a tree,
    but for the crowded regions, which were compared as a whole."""
    order = given.mapInArrow(lambda batches: _regions(rule, batches), _REGIONS)
    if crowded is not None:
        order = lookup(order, crowded, {"region": "crowded"}, "left_anti")
    total = given.count() * rule.trees
    cut, more = _blocks(order, rule)
    cut = cut.repartition(max(1, -(-(total + more) // rule.range_rows)), "region", "pair").sortWithinPartitions("region", "pair", "root")
    return cut.mapInArrow(lambda batches: _meetings(rule, last, batches), "a long, b long, more boolean")


def _crowds(given: DataFrame, rule: Forest, crowded: Stored, texts: DataFrame) -> DataFrame:
    """Links (a, b) of all candidates of the crowded regions, whose blocks get the texts."""
    order = given.mapInArrow(lambda batches: _regions(rule, batches), _REGIONS)
    order = store(lookup(order, crowded, {"region": "crowded"}, "left_semi"), UNMEASURED)
    cut, more = _blocks(order.df, rule, rule.block_shingles)
    size = order.df.agg(F.sum("n")).first()[0] * (order.rows + more) // order.rows
    tasks = max(1, -(-size // rule.block_shingles), -(-(order.rows + more) // (2 * rule.block_rows)))
    cut = cut.join(texts, "node").repartition(tasks, "region", "pair").sortWithinPartitions("region", "pair", "root")
    return cut.mapInArrow(lambda batches: _linked_within(rule, batches), "a long, b long")


def _blocks(order: DataFrame, rule: Forest, shingles: int | None = None) -> tuple[DataFrame, int]:
    """The rows of all regions, those of large ones once for every two blocks, and how many rows this adds."""
    regions = order.groupBy("region").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"), (F.min("root") != F.max("root")).alias("several")
    )
    blocks = F.ceil(F.col("rows") / rule.block_rows)
    if shingles is not None:
        blocks = F.greatest(blocks, F.least(F.ceil(F.col("n") / shingles), "rows"))
    big = regions.withColumn("blocks", blocks).where("blocks > 1")
    big = store(big.select(F.col("region").alias("r"), "rows", F.when(F.col("several"), F.col("blocks")).otherwise(0).alias("blocks")), 24)
    more = 0
    if big.rows:
        more = big.df.agg(F.sum((F.col("blocks") - 1) * F.col("rows"))).first()[0]
        blocks = F.coalesce("blocks", F.lit(1)).cast("long")
        cut = lookup(order, big.select("r", "blocks"), {"region": "r"}).select(*order.columns, blocks.alias("blocks"))
        # A region of one component has no blocks.
        cut = cut.where("blocks > 0").withColumn("part", F.pmod(F.xxhash64("node", F.lit("part")), F.col("blocks")))
        cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        pair = F.least("part", "other") * (1 << 31) + F.greatest("part", "other")
        side = F.when(F.col("part") == F.col("other"), -1).otherwise(F.col("part"))
    else:
        cut, pair, side = order, F.lit(0).cast("long"), F.lit(-1)
    return cut.select("region", pair.alias("pair"), side.cast("long").alias("side"), "tree", "node", "root", "n", "sketch", "regions"), more


def _texts_of(docs: DataFrame, rows: DataFrame, active: DataFrame) -> DataFrame:
    """(node, text): one text of each active class."""
    wanted = rows.join(active.select("node"), "node", "left_semi")
    first = store(wanted.groupBy("node").agg(F.min("doc_id").alias("doc_id")), 24)
    of = lookup(docs.select("doc_id", "text"), first.select(F.col("doc_id").alias("id"), "node"), {"doc_id": "id"}, "inner")
    return of.select("node", "text")


def near_duplicates(docs: DataFrame, rule: Forest = Forest()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row."""
    members, found = linked(docs, rule)
    found = store(found, 24)
    named = lookup(members, found.select(F.col("node").alias("n"), "component"), {"node": "n"})
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return named.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, rule: Forest = Forest()) -> DataFrame:
    """One document of each group, with its own columns. Rows without an id stay."""
    judged = near_duplicates(docs, rule)
    gone = store(judged.where("NOT kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("id")).distinct().withColumn("gone", F.lit(True)), 24)
    rows = with_row(docs, _id=docs["doc_id"])
    return unpack(lookup(rows, gone, {"_id": "id"}).where("gone IS NULL"))


def op5_neardup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), Forest(shingle=4))
