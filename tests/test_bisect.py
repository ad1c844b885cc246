"""Bisecting k-means against the same rule in numpy, row by row."""

import numpy as np
import pytest
from helpers import rows

from payscore.operators.bisect import ClusterTree, Node, assign_tree, fit_tree, load_tree, save_tree, tree_report

POINT = ("a", "b")


def two_means(x, max_iter):
    dim = int(np.argmax([len(x) * (x[:, d] ** 2).sum() - x[:, d].sum() ** 2 for d in range(x.shape[1])]))
    left = x[:, dim] <= x[:, dim].mean()
    centers = x[left].mean(0), x[~left].mean(0)
    for _ in range(max_iter):
        left = ((x - centers[0]) ** 2).sum(1) <= ((x - centers[1]) ** 2).sum(1)
        new = x[left].mean(0), x[~left].mean(0)
        if np.array_equal(new, centers):
            break
        centers = new
    return centers


def brute(x, k, max_iter=20):
    """Clusters of the rows, from left to right, and the cost."""
    names, centers, level = [""] * len(x), {"": x.mean(0)}, [""]
    leaves = 1
    while True:
        names = np.array(names, dtype=object)
        able = [n for n in level if len(np.unique(x[names == n], axis=0)) > 1]
        chosen = sorted(able, key=lambda n: -(names == n).sum())[: k - leaves]
        if not chosen:
            break
        level = []
        for n in sorted(chosen):
            centers[n + "0"], centers[n + "1"] = two_means(x[names == n], max_iter)
            for i in np.flatnonzero(names == n):
                near = [((x[i] - centers[n + s]) ** 2).sum() for s in "01"]
                names[i] = n + ("0" if near[0] <= near[1] else "1")
            level += [n + "0", n + "1"]
        leaves += len(chosen)
    order = sorted(set(names))
    cost = sum(((x[i] - centers[names[i]]) ** 2).sum() for i in range(len(x)))
    return [str(order.index(n)) for n in names], cost


def frame(spark, x, parts=3):
    return spark.createDataFrame([(i, *map(str, p)) for i, p in enumerate(x)], "id int, a string, b string").repartition(parts)


@pytest.mark.parametrize("k", [1, 2, 3, 4, 7])
def test_as_defined(spark, k):
    rng = np.random.default_rng(k)
    x = np.concatenate([rng.integers(0, 9, (150, 2)), rng.integers(20, 24, (40, 2)), np.full((60, 2), 5)])
    df = frame(spark, x)
    tree = fit_tree(df, k, POINT)
    clusters, cost = brute(x.astype(float), k)
    assert [r[1] for r in sorted(rows(assign_tree(df, tree, "c"), "id", "c"))] == clusters
    assert tree.cost == pytest.approx(cost) and len(tree.leaves) == k
    report = {r["cluster"]: r for r in tree_report(spark, tree).collect()}
    assert {c: r["n_rows"] for c, r in report.items()} == {c: clusters.count(c) for c in set(clusters)}
    means = {c: x[np.array(clusters) == c].mean(0) for c in report}
    assert all(np.allclose(r["center"], means[c]) for c, r in report.items())


def test_the_same_again_and_from_disk(spark, tmp_path):
    x = np.random.default_rng(9).integers(0, 30, (200, 2))
    tree = fit_tree(frame(spark, x), 5, POINT)
    # Summed in another order, costs may differ in their last digits.
    again = fit_tree(frame(spark, x, 7), 5, POINT)
    assert [(n.center, n.rows, n.left) for n in again.nodes] == [(n.center, n.rows, n.left) for n in tree.nodes]
    save_tree(spark, tree, str(tmp_path / "t"))
    assert load_tree(spark, str(tmp_path / "t")) == tree


def test_no_more_clusters_than_different_points(spark):
    tree = fit_tree(frame(spark, [(1, 1)] * 5 + [(2, 1)] * 3), 6, POINT)
    assert sorted(n.rows for n in (tree.nodes[i] for i in tree.leaves)) == [3, 5] and tree.cost == 0
    assert len(fit_tree(frame(spark, [(1, 1)] * 5), 4, POINT).nodes) == 1
    big = fit_tree(frame(spark, [(i, 0) for i in range(8)]), 8, POINT, min_rows=5)
    assert len(big.leaves) == 2


def test_missing_and_unparsable_buckets_count_as_zero(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "0", ""), (3, "9999", "0"), (4, "9999", None)], "id int, a string, b string")
    tree = fit_tree(df, 2, POINT)
    assert rows(assign_tree(df, tree, "c"), "id", "c") == [(1, "0"), (2, "0"), (3, "1"), (4, "1")]
    assert fit_tree(df.where("false"), 3, POINT) == ClusterTree((Node((0.0, 0.0)),), POINT)
    with pytest.raises(ValueError):
        fit_tree(df, 0, POINT)


def test_assignment_needs_no_join(spark):
    df = frame(spark, np.arange(40).reshape(20, 2))
    out = assign_tree(df, fit_tree(df, 4, POINT))
    plan = out._jdf.queryExecution().toString()
    assert "Join" not in plan and plan.count("Exchange") <= 2 * df._jdf.queryExecution().toString().count("Exchange")
