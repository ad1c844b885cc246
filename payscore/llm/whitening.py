"""Whitening of embeddings by shifted Cholesky QR.

Components are moved to whole numbers, so counts, sums and deviations are exact. Every different vector
counts once. The centred vectors X are made orthogonal in passes: a pass sums the Gram matrix of the rows,
each taken through the triangular solves of the passes before, and the driver factors it. The first pass
adds a small shift to the diagonal, without which the factoring of an ill-conditioned matrix would fail; the
passes after it remove what the shift left over, until the Gram matrix is the identity. So X = QR with R the
product of all factors, and R, a matrix of the width of a vector, holds all singular values and directions of
X, to the precision of X itself and not of its square. Its singular value decomposition U S V' gives the
components; a whitened row is its row of Q times U times sqrt(n), again by triangular solves.

Only sums and matrices of the vectors' width reach the driver; no pass shuffles a vector but the one that
finds the different ones, which combines equal vectors before the shuffle.

Nulls: rows without a vector, or with a null or non-finite component, take no part; a null ``vec_id`` stays
null. Vectors of another length than the most frequent one (the longer one on a tie), or of length 0, take no
part. Directions without variance (singular value below 1e-9 of the largest) are no components, so one vector
alone, or an empty table, gives no rows. Repeated rows each give their rows. Components of equal variance may
be turned among themselves; the sign is chosen so that the largest entry is positive. ``deviation`` is null
where it does not fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscore.llm.common import table
from payscore.llm.vectors import fixed_point, matrix, usable
from payscore.shared import Stored, store

COMPONENTS = 16
# Fixed value: added to every component, so that x is positive.
OFFSET = 1_000_000
#: Passes at most, singular values that count as none, and numbers worked on at a time.
PASSES, NOTHING, CHUNK = 10, 1e-9, 1 << 20
_SAFE = 1 << 62


@dataclass(frozen=True)
class Center:
    """The number of different vectors and the sums of their components, exact."""

    n: int
    sums: tuple[int, ...]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact: in longs where they suffice, else in whole numbers of any size."""
        most = max(int(np.abs(x).max(initial=0)), 1) * self.n + max(map(abs, self.sums))
        kind = np.int64 if most < _SAFE else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(np.float64)


def solve(rows: np.ndarray, factors: Sequence[np.ndarray]) -> np.ndarray:
    """``rows`` times the inverse of each upper triangular factor, by substitution column by column."""
    out = np.ascontiguousarray(rows.T)
    for r in factors:
        for j in range(len(r)):
            out[j] = (out[j] - r[:j, j] @ out[:j]) / r[j, j]
    return out.T


def _pieces(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    step = max(CHUNK // max(width, 1), 1)
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield part, matrix(part.column(part.schema.get_field_index("x")), width)


def center_of(fit: Stored, width: int) -> Center:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, object)
        for _, x in _pieces(batches, width):
            small = int(np.abs(x).max(initial=0)) * len(x) < _SAFE
            total += (x if small else x.astype(object)).sum(0).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([str(t) for t in total])], ["i", "s"])

    sums = fit.df.mapInArrow(run, "i int, s string").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    by_place = {r["i"]: int(r["s"]) for r in sums.collect()}
    return Center(fit.rows, tuple(by_place.get(i, 0) for i in range(width)))


def _summed(fit: Stored, width: int, size: int, rows_of) -> np.ndarray:
    """The sum over all rows of W'W, for W = rows_of(x) of ``size`` columns."""
    upper = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for _, x in _pieces(batches, width):
            w = rows_of(x)
            total += w.T @ w
        places = pa.array(np.arange(len(upper[0]), dtype=np.int32))
        yield pa.RecordBatch.from_arrays([places, pa.array(total[upper])], ["i", "s"])

    # A row per entry of the upper half, whatever the number of vectors.
    sums = fit.df.mapInArrow(run, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).toPandas()
    flat = np.zeros(len(upper[0]))
    flat[sums["i"].to_numpy()] = sums["s"].to_numpy()
    out = np.zeros((size, size))
    out[upper] = flat
    return out + np.triu(out, 1).T


def _factor(gram: np.ndarray, shifted: bool) -> np.ndarray:
    """The upper triangular R with R'R = gram, plus the least shift with which there is one."""
    shift = 100 * len(gram) * np.finfo(float).eps * np.trace(gram) if shifted else 0.0
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(100 * shift, len(gram) * np.finfo(float).eps * np.trace(gram))


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: factors of the passes, then one turn. ``directions`` has a component a row."""

    center: Center
    factors: tuple[np.ndarray, ...]
    turn: np.ndarray
    directions: np.ndarray
    variances: np.ndarray
    explained: np.ndarray

    @property
    def components(self) -> int:
        return len(self.variances)

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows of fixed-point rows."""
        return solve(self.center.centred(x), self.factors) @ self.turn


def fit_whitening(fit: Stored, width: int, components: int = COMPONENTS) -> Whitening:
    """Fit to a stored table of different vectors ``x``, each of ``width`` longs."""
    center = center_of(fit, width)
    factors: list[np.ndarray] = []
    for k in range(PASSES):
        done = tuple(factors)
        gram = _summed(fit, width, width, lambda x: solve(center.centred(x), done))
        if not np.trace(gram) > 0:
            break
        values = np.linalg.eigvalsh(gram)
        # Directions without variance stay at zero.
        if k > 1 and np.abs(values[values > 1e-6] - 1).max() < 1e-13 * width:
            break
        factors.append(_factor(gram, shifted=k == 0))
    if not factors:
        nothing = np.zeros(0)
        return Whitening(center, (), np.zeros((width, 0)), np.zeros((0, width)), nothing, nothing)
    whole = np.eye(width)
    for r in factors:
        whole = r @ whole
    u, s, v = np.linalg.svd(whole)
    k = min(components, int(np.count_nonzero(s > NOTHING * s[0])))
    signs = np.sign(v[np.arange(k), np.abs(v[:k]).argmax(1)])
    turn = u[:, :k] * signs * np.sqrt(center.n)
    return Whitening(center, tuple(factors), turn, v[:k] * signs[:, None], s[:k] ** 2 / center.n, s[:k] ** 2 / np.sum(s**2))


def identity_error(fit: Stored, width: int, made: Whitening) -> float:
    """The largest entry of the whitened rows' covariance minus the identity, measured over the fit list."""
    k = made.components

    def rows_of(x: np.ndarray) -> np.ndarray:
        return np.column_stack([made.apply(x), np.ones(len(x))])

    sums = _summed(fit, width, k + 1, rows_of) / made.center.n
    covariance = sums[:k, :k] - np.outer(sums[:k, k], sums[:k, k])
    return float(np.abs(covariance - np.eye(k)).max(initial=0.0))


def _squares(y: np.ndarray) -> list[int | None]:
    """Sums of squares of each row, exact; None beyond a long."""
    about = (y.astype(np.float64) ** 2).sum(1)
    if y.dtype == np.int64 and about.max(initial=0.0) < 9.2e18:
        return (y * y).sum(1).tolist()
    exact = (sum(int(v) ** 2 for v in row) if near < 9.3e18 else 1 << 63 for row, near in zip(y, about))
    return [v if v < 1 << 63 else None for v in exact]


_OUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whiten(df: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """The whitened components of each row (vec_id, vector), with what the fit says of itself."""
    rows = usable(df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("_vector")), "_vector")
    lengths = rows.groupBy(F.size("_vector").alias("n")).count().where("n > 0")
    usual = lengths.orderBy(F.desc("count"), F.desc("n")).first()
    if usual is None:
        return df.sparkSession.createDataFrame([], _OUT)
    width = usual["n"]
    x = F.transform(fixed_point("_vector"), lambda v: v + OFFSET)
    rows = rows.where(F.size("_vector") == width).select("vec_id", x.alias("x"))
    # Equal vectors meet before the shuffle, so one that fills a third of the table is no load.
    fit = store(rows.select("x").distinct())
    made = fit_whitening(fit, width, components)
    error, k, n = identity_error(fit, width, made), made.components, made.center.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _pieces(batches, width):
            if not k:
                continue
            which = np.repeat(np.arange(len(x)), k)
            arrays = [
                part.column(0).take(pa.array(which)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(which), n, np.int64)),
                pa.array(_squares(made.center.deviations(x)), pa.int64()).take(pa.array(which)),
                pa.array(made.apply(x).ravel()),
                pa.array(np.tile(made.explained, len(x))),
                pa.array(np.full(len(which), error)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, _OUT)


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
