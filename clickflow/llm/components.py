"""Connected components of an undirected graph by randomised contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.shared import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns ``a``, ``b``): ``root`` is the
    smallest node of its component.

    Each round hangs every node on the node of the smallest pseudorandom rank within two
    steps, and renames the edges' ends: a star is done in one round, and of longer shapes a
    constant share of the nodes disappears, so rounds grow with the logarithm of the longest
    path. Rounds are written to the shared folder. A hub costs no more than its edges: minima are taken
    with partial aggregation and joins are ordinary equi-joins that Spark may split.
    """
    current = written(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
    )
    steps: list[DataFrame] = []
    while not current.isEmpty():
        turn = F.lit(len(steps))
        rank = lambda c, turn=turn: F.struct(F.xxhash64(turn, F.col(c)).alias("r"), F.col(c).alias("n"))
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min(rank("b")).alias("best"))
        best = written(best.select("a", F.least(rank("a"), "best").alias("best")), "best")
        near = both.join(best.select(F.col("a").alias("b"), F.col("best").alias("near")), "b")
        up = near.groupBy("a").agg(F.min("near").alias("up"))
        step = written(up.select(F.col("a").alias("node"), F.col("up.n").alias("up")), "step")
        steps.append(step)
        ends = current
        for c in ("a", "b"):
            ends = ends.join(step.select(F.col("node").alias(c), F.col("up").alias(f"{c}2")), c)
        current = written(
            ends.where("a2 <> b2").select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(),
            "edges",
        )
    if not steps:
        kind = edges.schema["a"].dataType.simpleString()
        return edges.sparkSession.createDataFrame([], f"node {kind}, root {kind}")
    nodes = steps[0].select("node", F.col("up").alias("at"))
    for step in steps[1:]:
        moved = step.select(F.col("node").alias("at"), "up")
        nodes = nodes.join(moved, "at", "left").select("node", F.coalesce("up", "at").alias("at"))
    nodes = written(nodes, "nodes")
    roots = written(nodes.groupBy("at").agg(F.min("node").alias("root")), "roots")
    return nodes.join(roots, "at").select("node", "root")
