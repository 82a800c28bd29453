"""Connected components of an edge table by contraction to smallest neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapgraph.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(a, b): the smallest vertex b that each vertex a > b of ``edges`` (a, b) can reach.

    In each round every vertex moves to the smallest of its neighbours, and on to where that one
    moves; edges between moved vertices are what is left to do. Minima combine in the map tasks,
    joins meet a stored table that has each vertex once, so hot vertices can be split. Vertices
    are hashes, so their order is random and the edges left fall by a factor each round.
    """
    edges = stored(edges.where("a <> b").select("a", "b").distinct(), "edges")
    moves = []
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = stored(both.groupBy("a").agg(F.min("b").alias("b")).where("b < a"), "near")
        moved = near.alias("x").join(near.alias("y"), F.col("x.b") == F.col("y.a"), "left")
        moves.append(stored(moved.select("x.a", F.coalesce("y.b", "x.b").alias("b")), "moves"))
        edges = stored(relabelled(edges, moves[-1]).where("a <> b").distinct(), "edges")
    if not moves:
        return edges
    found = moves[0]
    for later in moves[1:]:
        found = followed(found, later)
    return stored(found, "components") if len(moves) > 1 else found


def relabelled(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """``edges`` with each end replaced by its label in ``labels`` (a, b), if it has one."""
    one = labels.select("a", F.col("b").alias("to_a"))
    other = labels.select(F.col("a").alias("b"), F.col("b").alias("to_b"))
    ends = edges.join(one, "a", "left").join(other, "b", "left")
    return ends.select(F.coalesce("to_a", "a").alias("a"), F.coalesce("to_b", "b").alias("b"))


def followed(labels: DataFrame, later: DataFrame) -> DataFrame:
    """Labels (a, b) after those of ``labels`` have moved on by ``later``, which adds its own vertices."""
    on = later.select(F.col("a").alias("b"), F.col("b").alias("to"))
    moved = labels.join(on, "b", "left").select("a", F.coalesce("to", "b").alias("b"))
    return moved.union(later.join(labels.select("a"), "a", "left_anti").select("a", "b"))
