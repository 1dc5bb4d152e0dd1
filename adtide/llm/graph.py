"""Connected components of a table of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtide.llm.common import discard, store


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first())


def components(links: DataFrame) -> DataFrame:
    """a, b: the smallest vertex b of the component of every vertex a > b that has a link.

    links: two columns of vertices (longs), in any order and repeated as they may be. A vertex with very many
    links is only ever reduced to a minimum, which each task does before the shuffle, and joined.
    """
    one, other = links.columns
    edges = links.where(F.col(one) != F.col(other)).select(F.greatest(one, other).alias("a"), F.least(one, other).alias("b"))
    edges = store(edges.distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        reached = store(hung.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "stars")
        discard(edges)
        before, edges, state = state, reached, _state(reached)
        if state == before:
            break
    return edges
