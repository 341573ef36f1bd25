"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailtriage.session import staged_table

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node of an edge with the smallest node it reaches.

    Each round hangs a node's larger neighbours, then its smaller ones, on its smallest neighbour; stars
    remain when nothing changes, after about as many rounds as the logarithm of the longest chain.  Only minima
    by key are aggregated, so a node with very many edges is combined before the shuffle; every round is
    written, so a lost executor redoes one round at most.
    """
    edges = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where(F.col("a") != F.col("b"))
    edges = staged_table(edges.distinct(), "edges")
    state = _state(edges)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (both.join(least, "a").where(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("u"), F.least("a", "m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("m").alias("a"), F.col("v").alias("b")), F.struct(F.col("m").alias("a"), F.col("u").alias("b")))).alias("e"))
        edges = staged_table(small.select("e.a", "e.b").where(F.col("a") != F.col("b")).distinct(), "edges")
        last, state = state, _state(edges)
        if state == last:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
