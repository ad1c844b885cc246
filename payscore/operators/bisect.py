"""Bisecting k-means with a result that can be checked.

Rows with the same point are merged first, so a pass costs as much as there are different points, and every
sum weighs a point by its rows. A cluster starts its split at the mean of its widest dimension and is then
refined by 2-means. All clusters of a level are split in the same passes; the largest go first when fewer
splits are left. Nothing is random and nothing depends on the order of rows, so training again gives the
same clusters.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payscore.functions import constant, let
from payscore.operators.cluster import FEATURES, _point
from payscore.shared import Stored, store
from payscore.sources.sinks import write_table

#: Nodes are literals in the expression that assigns rows.
MAX_CLUSTERS = 1000


@dataclass(frozen=True)
class Node:
    """A cluster: its center, rows and summed squared distance; ``left`` and ``right`` are -1 in a leaf."""

    center: tuple[float, ...]
    rows: int = 0
    cost: float = 0.0
    left: int = -1
    right: int = -1


@dataclass(frozen=True)
class ClusterTree:
    """A trained clustering: the root first, then the two halves of each split. Clusters are its leaves, from left to right."""

    nodes: tuple[Node, ...]
    features: tuple[str, ...] = FEATURES

    @property
    def leaves(self) -> list[int]:
        out, todo = [], [0]
        while todo:
            at = todo.pop()
            node = self.nodes[at]
            if node.left < 0:
                out.append(at)
            else:
                todo += [node.right, node.left]
        return out

    @property
    def depth(self) -> int:
        deep = [0] * len(self.nodes)
        for i, node in enumerate(self.nodes):  # halves come after the node they are of
            if node.left >= 0:
                deep[node.left] = deep[node.right] = deep[i] + 1
        return max(deep)

    @property
    def cost(self) -> float:
        return sum(self.nodes[i].cost for i in self.leaves)


def _ints(values: Sequence[int]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _distance(point: Column, center: Column) -> Column:
    return F.aggregate(F.zip_with(point, center, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x)


def _left_is_nearer(point: Column, left: Column, right: Column) -> Column:
    return _distance(point, left) <= _distance(point, right)


def node_of(point: Column, nodes: Sequence[Node], depth: int) -> Column:
    """The node a point ends in: at each split the half with the nearer center, the left one on a tie."""
    if not depth:
        return F.lit(0)
    left, right = _ints([n.left for n in nodes]), _ints([n.right for n in nodes])
    centers = constant([n.center for n in nodes])

    def down(node: Column, _: Column) -> Column:
        a, b = F.get(left, node), F.get(right, node)
        nearer = F.when(_left_is_nearer(point, F.get(centers, a), F.get(centers, b)), a).otherwise(b)
        return F.when(a < 0, node).otherwise(nearer)

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), down)


@dataclass
class _Half:
    """Sums over the points of a half: rows, and per dimension the sum, the sum of squares and the ends."""

    rows: int
    sums: list[float]
    squares: list[float]
    lows: list[float]
    highs: list[float]

    @property
    def center(self) -> tuple[float, ...]:
        return tuple(s / self.rows for s in self.sums)

    @property
    def widest(self) -> int | None:
        """The dimension of most variance, the first on a tie; None when all points are one."""
        spread = [
            self.rows * q - s * s if low < high else None
            for q, s, low, high in zip(self.squares, self.sums, self.lows, self.highs)
        ]
        found = [v for v in spread if v is not None]
        return spread.index(max(found)) if found else None


def _halves(points: DataFrame, dims: int, node: Column, chosen: Sequence[int], is_left: Column) -> dict[tuple[int, bool], _Half]:
    """What :class:`_Half` holds, for both halves of the chosen nodes: one pass, two short rows for each node."""
    cnt = F.col("cnt")
    values = [F.get("point", F.lit(d)) for d in range(dims)]
    sides = points.withColumn("node", node)
    if chosen:
        sides = sides.where(F.col("node").isin(list(chosen)))
    rows = (
        sides.withColumn("half", is_left)
        .groupBy("node", "half")
        .agg(
            F.sum(cnt).alias("rows"),
            F.array(*[F.sum(v * cnt) for v in values]).alias("sums"),
            F.array(*[F.sum(v * v * cnt) for v in values]).alias("squares"),
            F.array(*[F.min(v) for v in values]).alias("lows"),
            F.array(*[F.max(v) for v in values]).alias("highs"),
        )
        .collect()
    )
    return {(r["node"], r["half"]): _Half(r["rows"], r["sums"], r["squares"], r["lows"], r["highs"]) for r in rows}


def profile_points(df: DataFrame, features: Sequence[str] = FEATURES) -> Stored:
    """The different points with their rows. Missing and unparsable buckets count as 0."""
    return store(df.groupBy(_point(features).alias("point")).agg(F.count(F.lit(1)).alias("cnt")))


def fit_tree(
    df: DataFrame, k: int, features: Sequence[str] = FEATURES, max_iter: int = 20, min_rows: int = 1
) -> ClusterTree:
    """Split until there are ``k`` clusters, or none of ``min_rows`` rows or more that holds different points.

    An empty table gives one cluster without rows, at the origin.
    """
    if not 1 <= k <= MAX_CLUSTERS:
        raise ValueError(f"1 to {MAX_CLUSTERS} clusters")
    points, dims = profile_points(df, features).df, len(features)
    root = _halves(points, dims, F.lit(0), [], F.lit(True)).get((0, True))
    if root is None:
        return ClusterTree((Node((0.0,) * dims),), tuple(features))
    nodes, facts, level, depth = [Node(root.center, root.rows)], {0: root}, [0], 0
    while True:
        room = k - (len(nodes) + 1) // 2
        able = [i for i in level if facts[i].widest is not None and facts[i].rows >= min_rows]
        chosen = sorted(able, key=lambda i: (-facts[i].rows, i))[:room]
        if not chosen:
            break
        node = node_of(F.col("point"), nodes, depth)
        dim = _ints([facts[i].widest if i in chosen else 0 for i in range(len(nodes))])
        mean = constant([facts[i].center[facts[i].widest] if i in chosen else 0.0 for i in range(len(nodes))])
        halves = _halves(points, dims, node, chosen, F.get("point", F.get(dim, F.col("node"))) <= F.get(mean, F.col("node")))
        for _ in range(max_iter):
            centers = {side: constant([halves[i, side].center if i in chosen else nodes[i].center for i in range(len(nodes))])
                       for side in (True, False)}
            nearer = _left_is_nearer(F.col("point"), *[F.get(centers[side], F.col("node")) for side in (True, False)])
            again = _halves(points, dims, node, chosen, nearer)
            still = all(again[x].center == halves[x].center for x in again)
            halves = again
            if still:
                break
        level = []
        for i in sorted(chosen):
            nodes[i] = replace(nodes[i], left=len(nodes), right=len(nodes) + 1)
            for side in (True, False):
                level.append(len(nodes))
                facts[len(nodes)] = halves[i, side]
                nodes.append(Node(halves[i, side].center, halves[i, side].rows))
        depth += 1
    return _measured(points, ClusterTree(tuple(nodes), tuple(features)))


def _measured(points: DataFrame, tree: ClusterTree) -> ClusterTree:
    """The tree with the rows and the cost that its own assignment gives each leaf."""
    centers = constant([n.center for n in tree.nodes])
    at = points.withColumn("node", node_of(F.col("point"), tree.nodes, tree.depth))
    cost = F.sum(F.col("cnt") * _distance(F.col("point"), F.get(centers, F.col("node"))))
    found = {r["node"]: r for r in at.groupBy("node").agg(F.sum("cnt").alias("rows"), cost.alias("cost")).collect()}
    nodes = [
        n if n.left >= 0 else replace(n, rows=found[i]["rows"] if i in found else 0, cost=found[i]["cost"] if i in found else 0.0)
        for i, n in enumerate(tree.nodes)
    ]
    return replace(tree, nodes=tuple(nodes))


def assign_tree(df: DataFrame, tree: ClusterTree, out: str = "acc_cust_km") -> DataFrame:
    """Add the cluster of each row, as text: a projection, where the row is."""
    leaves = tree.leaves
    number = _ints([leaves.index(i) if i in leaves else -1 for i in range(len(tree.nodes))])
    cluster = let(_point(tree.features), lambda p: F.get(number, node_of(p, tree.nodes, tree.depth)))
    return df.withColumn(out, cluster.cast("string"))


def tree_report(spark: SparkSession, tree: ClusterTree) -> DataFrame:
    """One row per cluster of a trained clustering: cluster, center, rows and cost in training."""
    rows = [(str(c), list(tree.nodes[i].center), tree.nodes[i].rows, tree.nodes[i].cost) for c, i in enumerate(tree.leaves)]
    return spark.createDataFrame(rows, "cluster string, center array<double>, n_rows long, cost double")


def save_tree(spark: SparkSession, tree: ClusterTree, path: str) -> None:
    """Replace ``path`` by the tree's nodes, a row each."""
    rows = [(i, n.left, n.right, list(n.center), n.rows, n.cost, list(tree.features)) for i, n in enumerate(tree.nodes)]
    schema = "node int, left int, right int, center array<double>, n_rows long, cost double, features array<string>"
    write_table(spark.createDataFrame(rows, schema), path)


def load_tree(spark: SparkSession, path: str) -> ClusterTree:
    rows = spark.read.parquet(path).orderBy("node").limit(2 * MAX_CLUSTERS).collect()
    nodes = [Node(tuple(r["center"]), r["n_rows"], r["cost"], r["left"], r["right"]) for r in rows]
    return ClusterTree(tuple(nodes), tuple(rows[0]["features"]))
