"""Connected components of an edge table, by alternating large and small stars.

Each round is joins and aggregates over edges only; nothing is collected. Every
round is written to the shared folder, so an executor's loss repeats one round.
A vertex of very high degree is one row of the minimum table, and adaptive
execution may split its edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import dropped, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (a, b), a != b -> edges to the smallest neighbour.

    Large star: every vertex links its greater neighbours to its smallest
    neighbour (or itself). Small star: every vertex links its smaller neighbours
    and itself to the smallest of them.
    """
    if large:
        near = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m"))
    linked = near.join(least, "a")
    if large:
        out = linked.where(F.col("b") > F.col("a")).select(
            F.col("b").alias("a"), F.least("m", "a").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def _edges(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def joined(edges: DataFrame) -> DataFrame:
    """(vertex, root): labels after one round of stars. Vertices of one label are
    connected, but a component may still have several; cheap, for use on the way."""
    now = _star(_star(_edges(edges), True), False)
    return now.groupBy(F.col("a").alias("vertex")).agg(F.min("b").alias("root"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(vertex, root) for every vertex of ``edges`` (a, b) that is not itself a
    root; the root is its component's smallest vertex."""
    now = written(_edges(edges), "edges")
    before = None
    for _ in range(max_rounds):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return now.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
        before, last = state, now
        now = written(_star(_star(now, True), False), "edges")
        dropped(last)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
