"""Whitening and exact search against brute force in numpy."""

import numpy as np
import pytest

from payscore.llm import search, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, v int, uid string, part string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, "x", 2, "u", "p") for i, v in rows], SCHEMA).repartition(parts)


def odd_rows(width):
    return [(-1, None), (-2, [None] * width), (-3, [float("nan")] * width), (-20, [float("inf")] + [0.0] * (width - 1)), (-5, [])]


def fixed(vectors):
    return np.floor(64 * np.asarray(vectors, np.float32).astype(np.float64)).astype(np.int64)


# Whitening


def correlated(n, width, seed=0):
    """Vectors of very unequal spread in directions across the dimensions."""
    rng = np.random.default_rng(seed)
    turn = np.linalg.qr(rng.normal(size=(width, width)))[0]
    return (rng.normal(size=(n, width)) * np.geomspace(300, 0.05, width)) @ turn


def test_whitening(spark, monkeypatch):
    monkeypatch.setattr(whitening, "CHUNK", 100)
    vectors = correlated(500, 20).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    rows += [(None, rows[0][1]), (7, rows[7][1])] + [(1000 + i, rows[3][1]) for i in range(200)] + odd_rows(20) + [(5, [1.0] * 19)]
    got = whitening.whiten(frame(spark, rows)).toPandas()
    x = np.unique(fixed(vectors), axis=0) + whitening.OFFSET
    n, sums = len(x), x.sum(0)
    assert set(got["n"]) == {n} and got["identity_error"].max() < 1e-9 and got["identity_error"].nunique() == 1
    assert len(got) == 702 * 16 and got["vec_id"].isna().sum() == 16
    values, axes = np.linalg.eigh(np.cov(x.T, bias=True))
    values, axes = values[::-1], axes[:, ::-1]
    first = got.drop_duplicates("component").sort_values("component")
    assert np.allclose(first["explained"], values[:16] / values.sum(), rtol=1e-6)
    one = got[got["vec_id"] == 3].sort_values("component")
    y = fixed(vectors[3:4])[0] + whitening.OFFSET
    assert set(one["deviation"]) == {int(((n * y - sums).astype(object) ** 2).sum())}
    expected = (y - sums / n) @ axes[:, :16] / np.sqrt(values[:16])
    assert np.allclose(np.abs(one["whitened"]), np.abs(expected), rtol=1e-5, atol=1e-7)
    # The sign is the same in all rows.
    w = got[got["vec_id"].between(0, 499) & ~got["vec_id"].isin([5, 7])].pivot(index="vec_id", columns="component", values="whitened")
    whole = (fixed(vectors[w.index.astype(int)]) + whitening.OFFSET - sums / n) @ axes[:, :16] / np.sqrt(values[:16])
    assert np.allclose(np.abs((w.to_numpy() * np.sign(whole)).sum(0)), np.abs(whole).sum(0), rtol=1e-4)


@pytest.mark.parametrize("kind", ["constant", "twice", "few"])
def test_whitening_without_variance(spark, kind):
    """Directions without variance are no components."""
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(5 if kind == "few" else 60, 6)) * 3
    if kind == "constant":
        vectors[:, 2] = 1.5
    if kind == "twice":
        vectors[:, 4] = vectors[:, 1]
    got = whitening.whiten(frame(spark, [(i, [float(c) for c in v]) for i, v in enumerate(vectors)])).toPandas()
    assert got["component"].max() == (4 if kind == "few" else 5)
    assert got["identity_error"].max() < 1e-9 and np.isfinite(got["whitened"]).all()
    assert got.drop_duplicates("component")["explained"].sum() == pytest.approx(1)


def test_whitening_of_nothing(spark):
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0])] * 3)).collect() == []
    assert whitening.whiten(frame(spark, odd_rows(3))).collect() == []
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []


def test_large_components(spark):
    """Beyond a long nothing fails: such a deviation is null."""
    rows = [(i, [1e15 * i, float(i % 3)]) for i in range(6)] + [(9, [1e37, 0.0])]
    got = whitening.whiten(frame(spark, rows)).toPandas()
    assert got["deviation"].isna().all() and got["n"].max() == 7 and np.isfinite(got["whitened"]).all()


# Search


def brute(rows, k=20, every=20):
    """query_id, rank, vec_id, score; rows are (vec_id, vector) with whole-number vectors of one width."""
    out = []
    for q, (qid, qv) in enumerate(rows):
        if qid is None or qid % every:
            continue
        scores = [(-sum(a * b for a, b in zip(qv, v)), i is None, i or 0, i) for c, (i, v) in enumerate(rows) if c != q]
        scores.sort(key=lambda s: s[:3])
        out += [(qid, r + 1, i, -s) for r, (s, _, _, i) in enumerate(scores[:k])]
    return sorted(out, key=str)


def answers(spark, rows, parts=3):
    return sorted((tuple(r) for r in search.search(frame(spark, rows, parts)).collect()), key=str)


@pytest.mark.parametrize("spread", [0.05, 4.0])
def test_search(spark, spread, monkeypatch):
    """Small blocks, parts and batches, so that limits pass from round to round; many ties with the small spread."""
    for name, value in {"BLOCK": 16, "PART": 32, "STEP": 3, "TOGETHER": 4, "BATCH_BYTES": 1000, "GROWTH": 2}.items():
        monkeypatch.setattr(search, name, value)
    rng = np.random.default_rng(2)
    vectors = (rng.normal(size=(400, 10)) * spread * np.geomspace(1, 0.01, 10)).astype(np.float32)
    vectors[100:220] = vectors[40]  # a third of the table is one vector
    ids = list(range(-20, 380))
    rows = [(i, [float(c) for c in v]) for i, v in zip(ids, vectors)]
    rows += [(None, rows[60][1]), (40, rows[60][1]), (40, rows[60][1]), (60, [0.0] * 10)]
    whole = [(i, fixed(v).tolist()) for i, v in rows]
    assert answers(spark, rows + odd_rows(10)[:4]) == brute(whole)


def test_search_unequal_lengths_and_few_rows(spark):
    rows = [(0, [1.0, 2.0]), (20, [1.0]), (3, []), (4, [-1.0, 0.5])]
    whole = [(i, (fixed(v).tolist() + [0, 0])[:2]) for i, v in rows]
    assert answers(spark, rows) == brute(whole)
    assert answers(spark, odd_rows(2)) == [] == answers(spark, [(1, [1.0])])
    assert search.search(spark.createDataFrame([], SCHEMA)).collect() == []


def test_search_large_components(spark):
    """Products beyond double precision are whole numbers; those beyond a long count as the largest."""
    rows = [(20 * i, [float(2**20 + i), float(2**18 * i), 1.0]) for i in range(8)]
    whole = [(i, fixed(v).tolist()) for i, v in rows]
    assert answers(spark, rows) == brute(whole)
    top = max(s for *_, s in answers(spark, [(0, [1e30]), (1, [1e30]), (2, [1.0])]))
    assert top == 2**63 - 1


def test_pruned_pairs_are_the_same():
    """Bounds drop most pairs and none that reaches its limit."""
    rng = np.random.default_rng(4)
    q = rng.integers(-50, 50, (30, 64)).astype(float) * np.geomspace(1, 0.02, 64).round(2)
    c = np.floor(rng.integers(-50, 50, (64, 500)) * np.geomspace(1, 0.02, 64)[:, None])
    q = np.floor(q)
    scores = q @ c
    limits = np.sort(scores, axis=1)[:, -5]
    rows, cols, got = search._bounded(q, c, limits, 6)
    found = set(zip(rows.tolist(), cols.tolist(), got.tolist()))
    assert {(i, j, scores[i, j]) for i, j in zip(*np.nonzero(scores >= limits[:, None]))} <= found
    assert len(found) < scores.size / 10
