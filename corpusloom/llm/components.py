"""Connected components of a distributed edge list by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import discard, stored


def _roots(step: DataFrame) -> DataFrame:
    """(node, to): each node's pointer followed to its root, the nodes that point to themselves.

    Pointers only go to smaller nodes, so they form trees; jumping halves their depth each
    time. Nodes that point to a root already match nothing.
    """
    while True:
        inner = step.where("node <> to").select(F.col("node").alias("to"), F.col("to").alias("beyond"))
        if step.where("node <> to").join(inner, "to", "left_semi").isEmpty():
            return step
        jumped = step.join(inner, "to", "left").select("node", F.coalesce("beyond", "to").alias("to"))
        old, step = step, stored(jumped, "step")
        discard(old)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b: long); component is the
    smallest node reachable.

    Each round hooks every node to the smallest node among itself and its neighbours, follows
    the hooks to their roots, rewrites the edges between roots and drops the loops. A node that
    stays alone in a round has a smaller neighbour in the next, so two rounds at least halve
    the graph: rounds are logarithmic in its size, and a chain in ascending order takes one.
    Minima are taken with map-side partial aggregates, so the neighbours of a hub never meet
    in one task.
    """
    spark = edges.sparkSession
    edges = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    nodes = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("to"))
        step = _roots(stored(step, "step"))
        left, right = step.toDF("a", "to_a"), step.toDF("b", "to_b")
        rest = edges.join(left, "a").join(right, "b").where("to_a <> to_b")
        rest = rest.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct()
        rest = stored(rest, "edges")
        if nodes is None:
            moved = step.withColumnRenamed("to", "component")
        else:
            follow = step.withColumnRenamed("node", "component")
            moved = stored(nodes.join(follow, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "nodes")
            discard(nodes, step)
        discard(edges)
        edges, nodes = rest, moved
    if nodes is None:
        return spark.createDataFrame([], "node long, component long")
    return nodes
