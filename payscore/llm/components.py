"""Connected components of a graph given as pairs of numbers, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscore.shared import store

#: Pairs that one task handles; a graph of few pairs needs few tasks.
TASK_ROWS = 100_000


def _star(edges: DataFrame) -> DataFrame:
    """(v, least): the least of each node and its neighbours. Combined before the shuffle, so hubs are no load."""
    return edges.groupBy("v").agg(F.least(F.col("v"), F.min("u")).alias("least"))


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) for every node of the pairs (a, b); the root is the least node of its component.

    Every round links each node to the least node it knows, first from its larger neighbours, then
    from its smaller ones, until nothing changes. The state is a table of pairs, written each round.
    """
    edges = pairs.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    before, tasks = None, None
    while True:
        stored = store(edges if tasks is None else edges.coalesce(tasks))
        edges, tasks = stored.df, 4 + stored.rows // TASK_ROWS
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_star(both).coalesce(tasks), "v").where("u > v").select(F.col("u"), F.col("least").alias("v")).where("u != v")
        large = large.coalesce(tasks).distinct().coalesce(tasks)
        # Small star: every node hands its smaller neighbours, and itself, to the least of them.
        down = large.select(F.col("u").alias("v"), F.col("v").alias("u"))
        small = down.join(_star(down).coalesce(tasks), "v").coalesce(tasks)
        handed = small.select(F.explode(F.array(F.struct("u", F.col("least").alias("v")), F.struct(F.col("v").alias("u"), F.col("least").alias("v")))).alias("e"))
        edges = handed.select("e.u", "e.v").where("u != v").distinct()
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
