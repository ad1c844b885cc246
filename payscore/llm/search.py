"""Exact top-k search by inner product: columnar branch and bound.

Vectors are stored once in blocks of rows in vertical layout, one dimension after the other. Queries go to
all blocks in batches of proven size. For a batch and a block the products are summed up a few dimensions at
a time, those with most mass first; after each step a pair stays only if what it has, plus the most the other
dimensions can add (Cauchy-Schwarz on the remaining masses of both), reaches the score of the query's k-th best
found so far. Survivors are compacted, and the rest of their dimensions gathered. Bounds are rounded up, so the
result is exact, ties included.

A query's limit comes from the blocks searched before: the first 16 parts of the table, then 256, and so on, with
the k-th best score of each round as limit of the next, so a round adds a bounded number of rows per query,
whatever the number of blocks.

Nulls: rows without a vector, or with a null or non-finite component, take no part. A row without ``vec_id`` is
no query, and comes after all others on ties (the largest long stands for it). Vectors of different lengths count as filled up with zeros (an empty
one scores 0 with all). Rows with equal ids are different rows: each asks for itself, and a row is excluded from
its own answer only. Ties go to the smaller ``vec_id``. Scores beyond a long count as the largest or smallest one.
An empty table, or one without queries, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from payscore.llm.common import table
from payscore.llm.vectors import fixed_point, usable
from payscore.shared import Stored, store

TOP = 20
EVERY = 20
#: Rows of a block and of a part of the table, dimensions per step, queries worked on at a time, bytes of a batch
#: of queries, and the growth of rounds.
BLOCK, PART, STEP, TOGETHER, BATCH_BYTES, GROWTH = 4096, 16_384, 16, 512, 32 << 20, 16
_NO_ID = np.iinfo(np.int64).max
#: Products and sums of them up to this size are exact in double precision.
_EXACT = float(1 << 52)


def _padded(column: pa.ListArray, width: int) -> np.ndarray:
    """Lists of longs as rows of a matrix, filled up with zeros."""
    sizes = column.value_lengths().to_numpy()
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def store_blocks(rows: Stored, width: int) -> Stored:
    """Blocks of rows (uid, vec_id, v): ids, and all components dimension after dimension in the smallest type."""
    parts = max(-(-rows.rows // PART), 1)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(held: pa.Table) -> pa.RecordBatch:
            held = held.combine_chunks()
            x = _padded(held["v"].combine_chunks(), width)
            kind = np.min_scalar_type(int(np.abs(x).max(initial=0)) * -1 - 1)
            uids, ids = (pa.array([held[c].to_pylist()], pa.list_(pa.int64())) for c in ("uid", "vec_id"))
            slab = pa.array([np.ascontiguousarray(x.T.astype(kind)).tobytes()], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), uids, ids, pa.array([kind.str]), slab], names)

        part = TaskContext.get().partitionId()
        names = ["part", "uids", "ids", "kind", "slab"]
        held: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                room = BLOCK - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(b.num_rows for b in held) == BLOCK:
                    yield block(pa.Table.from_batches(held))
                    held = []
        if held:
            yield block(pa.Table.from_batches(held))

    blocks = rows.df.select("uid", "vec_id", "v").repartition(parts).mapInArrow(
        pack, "part int, uids array<long>, ids array<long>, kind string, slab binary"
    )
    return store(blocks)


@dataclass
class Queries:
    """A batch of queries: row numbers, vectors, and the score each answer has to reach."""

    uids: np.ndarray
    vectors: np.ndarray
    limits: np.ndarray


def _bounded(q: np.ndarray, c: np.ndarray, limits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, column, score) of all pairs whose score reaches the query's limit, and k per query at least.

    ``q`` has a query a row, ``c`` a dimension a row; both hold whole numbers.
    """
    width = len(c)
    steps = [slice(a, min(a + STEP, width)) for a in range(0, width, STEP)]
    q_mass = np.array([(q[:, s] ** 2).sum(1) for s in steps]).reshape(len(steps), len(q))
    c_mass = np.array([(c[s] ** 2).sum(0) for s in steps]).reshape(len(steps), c.shape[1])
    order = np.argsort(-q_mass.sum(1) * c_mass.sum(1), kind="stable")
    part, rows, cols = np.zeros((len(q), c.shape[1])), None, None
    for i, b in enumerate(order):
        s = steps[b]
        if rows is None:
            part += q[:, s] @ c[s]
        else:
            for d in range(s.start, s.stop):
                part += q[rows, d] * c[d, cols]
        left = order[i + 1 :]
        if not len(left):
            break
        # The mass that the other dimensions have, a little more for rounding.
        q_rest = np.sqrt(q_mass[left].sum(0)) * (1 + 1e-9) + 1e-9
        c_rest = np.sqrt(c_mass[left].sum(0)) * (1 + 1e-9) + 1e-9
        if rows is None:
            alive = part + np.outer(q_rest, c_rest) + 0.5 >= limits[:, None]
            if np.count_nonzero(alive) * 10 <= alive.size:
                rows, cols = np.nonzero(alive)
                part = part[rows, cols]
        else:
            alive = part + q_rest[rows] * c_rest[cols] + 0.5 >= limits[rows]
            rows, cols, part = rows[alive], cols[alive], part[alive]
    if rows is None:
        low = limits
        if c.shape[1] > k:
            low = np.maximum(low, np.partition(part, c.shape[1] - k, axis=1)[:, c.shape[1] - k])
        rows, cols = np.nonzero(part >= low[:, None])
        return rows, cols, part[rows, cols]
    enough = part >= limits[rows]
    return rows[enough], cols[enough], part[enough]


def _plain(q: np.ndarray, c: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As :func:`_bounded`, with whole numbers of any size."""
    scores = np.clip(q.astype(object) @ c.astype(object), -_NO_ID - 1, _NO_ID).astype(np.int64)
    rows, cols = np.nonzero(scores >= limits.astype(object)[:, None])
    return rows, cols, scores[rows, cols]


def _searcher(queries, width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: Queries = queries.value
        given = asked.limits
        limits = given.copy()
        vectors = asked.vectors.astype(np.float64)
        largest = float(np.abs(vectors).max(initial=0.0))
        best = [np.zeros(0, np.int64) for _ in range(3)]  # query, id, score

        def merge(found: list[list[np.ndarray]]) -> list[np.ndarray]:
            query, ids, score = (np.concatenate(xs) for xs in zip(best, *found))
            order = np.lexsort((ids, -1 - score, query))
            query, ids, score = query[order], ids[order], score[order]
            first = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else np.zeros(0, np.int64)
            place = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
            full = place == k - 1
            limits[query[full]] = np.maximum(limits[query[full]], score[full])
            keep = place < k
            return [query[keep], ids[keep], score[keep]]

        for batch in batches:
            for i in range(batch.num_rows):
                uids, ids = (batch.column(batch.schema.get_field_index(c))[i].values for c in ("uids", "ids"))
                uids, ids = uids.to_numpy(), ids.fill_null(_NO_ID).to_numpy()
                kind = np.dtype(batch.column(batch.schema.get_field_index("kind"))[i].as_py())
                slab = np.frombuffer(batch.column(batch.schema.get_field_index("slab"))[i].as_buffer(), kind).reshape(width, len(uids))
                c = slab.astype(np.float64)
                exact = largest * float(np.abs(c).max(initial=0.0)) * max(width, 1) < _EXACT
                for at in range(0, len(vectors), TOGETHER):
                    here = slice(at, at + TOGETHER)
                    if exact:
                        # The query's own row may be among its best.
                        rows, cols, scores = _bounded(vectors[here], c, limits[here].astype(np.float64), k + 1)
                    else:
                        rows, cols, scores = _plain(asked.vectors[here], slab, limits[here])
                    other = asked.uids[rows + at] != uids[cols]
                    rows, cols, scores = rows[other], cols[other], scores[other]
                    if len(rows):
                        best = merge([[rows + at, ids[cols], scores.astype(np.int64)]])
        query, ids, score = best
        for at in range(0, len(query), 10_000):
            here = slice(at, at + 10_000)
            vec_id = pa.array(ids[here], mask=ids[here] == _NO_ID)
            yield pa.RecordBatch.from_arrays([pa.array(asked.uids[query[here]]), vec_id, pa.array(score[here])], ["uid", "vec_id", "score"])

    return run


def _search_batch(blocks: Stored, parts: int, batch: DataFrame, width: int, k: int) -> DataFrame:
    """The k best of each query of one batch (uid, vec_id as query_id, v): query_id, uid, rank, vec_id, score."""
    spark = batch.sparkSession
    rows = batch.select("uid", "v").toArrow().combine_chunks()
    uids = rows["uid"].to_numpy()
    order = np.argsort(uids)
    vectors = _padded(rows["v"].combine_chunks(), width)[order]
    asked = Queries(uids[order], vectors, np.full(len(uids), -_NO_ID - 1, np.int64))
    best, low, high = None, 0, GROWTH
    while True:
        sent = spark.sparkContext.broadcast(asked)
        here = blocks.df.where((F.col("part") >= low) & (F.col("part") < high))
        found = here.mapInArrow(_searcher(sent, width, k), "uid long, vec_id long, score long")
        found = found if best is None else found.unionByName(best.df.select("uid", "vec_id", "score"))
        order_by = Window.partitionBy("uid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
        best = store(found.withColumn("rank", F.row_number().over(order_by)).where(F.col("rank") <= k))
        sent.unpersist()
        if high >= parts:
            names = batch.select(F.col("uid").alias("_q"), F.col("vec_id").alias("query_id"))
            return best.df.join(names, F.col("uid") == F.col("_q"))
        last = best.df.where(F.col("rank") == k).select("uid", "score").toArrow()
        limits = asked.limits.copy()
        limits[np.searchsorted(asked.uids, last["uid"].to_numpy())] = last["score"].to_numpy()
        asked = Queries(asked.uids, asked.vectors, limits)
        low, high = high, high * GROWTH


def search(df: DataFrame, k: int = TOP, every: int = EVERY, vector: str = "embedding") -> DataFrame:
    """For each row whose ``vec_id`` is divisible by ``every``: query_id, rank, vec_id, score of its k best."""
    spark = df.sparkSession
    good = usable(df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("_vector")), "_vector")
    rows = store(good.select(F.monotonically_increasing_id().alias("uid"), "vec_id", fixed_point("_vector").alias("v")))
    is_query = F.col("vec_id") % every == 0
    facts = rows.df.agg(F.max(F.size("v")).alias("width"), F.count(F.when(is_query, 1)).alias("queries")).first()
    width, n = facts["width"] or 0, facts["queries"]
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    blocks = store_blocks(rows, width)
    parts = max(-(-rows.rows // PART), 1)
    batches = -(-n * (8 * width + 32) // BATCH_BYTES)
    asked = rows.df.where(is_query).withColumn("batch", F.pmod(F.xxhash64("uid"), F.lit(batches)).cast("int"))
    out = None
    for i in range(batches):
        found = _search_batch(blocks, parts, asked.where(F.col("batch") == i), width, k)
        out = found if out is None else out.unionByName(found)
    return out.select("query_id", "rank", "vec_id", "score")


def op13_search(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))


#: Every query with every row.
OP13_SQL = f"""
WITH rows AS MATERIALIZED (
  SELECT row_number() OVER () AS uid, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.uid, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM rows q JOIN rows c ON q.uid <> c.uid WHERE q.vec_id % {EVERY} = 0
)
SELECT query_id, row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= {TOP}
"""
