"""Connected components of an edge table, all of it on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import stored


def _star(edges: DataFrame) -> DataFrame:
    """Hang every node, and all its smaller neighbours, below the smallest of them."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    down = edges.join(low, "a").select(F.col("b").alias("x"), "m")
    own = low.select(F.col("a").alias("x"), "m")
    return down.union(own).where("x <> m").select(F.col("x").alias("a"), F.col("m").alias("b")).distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """Node and smallest node reachable from it, for every node that has an edge.

    ``edges`` has two bigint columns, read as undirected; nulls and loops are ignored.  Alternates two star steps: hang
    a node's larger neighbours, then its smaller ones, below the smallest neighbour.  Both keep the components and only
    make labels smaller, so the rounds are few (about the logarithm of the longest path); each is one table in the
    shared folder.  The minimum per node is aggregated before the shuffle, and a node with very many edges is an
    ordinary skewed join, which adaptive execution splits.  The driver sees two numbers a round.
    """
    a, b = edges.columns
    edges = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b and a is not null and b is not null")
    edges = stored(edges.distinct())
    state = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        edges = stored(_star(large))
        now = _state(edges)
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = now
