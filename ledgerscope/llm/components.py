"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.llm.common import cut, merged


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


#: edges that a task of the later steps handles
EDGES_PER_TASK = 250_000


def connected(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges (a, b)`` but the roots; the root is the smallest node.

    Every step keeps at most one edge for each edge it read, links each node to the smallest
    neighbour, and is written to the checkpoint folder twice. Joins are shuffled: the driver holds plans
    and two numbers a step, whatever the edges. A node
    with very many neighbours is aggregated map-side; its edges meet its minimum in a join that
    adaptive execution can split.
    """
    edges = cut(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = _state(edges)
    tasks = -(-before[0] // EDGES_PER_TASK)  # the number of edges never grows
    while before[0]:
        edges = edges.coalesce(tasks)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: each larger neighbour goes to the smallest of the neighbourhood
        grown = both.join(merged(nearest), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = cut(grown.distinct().coalesce(tasks))
        # small star: smaller neighbours and the node itself go to the smallest
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(merged(lowest), "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut(small.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
