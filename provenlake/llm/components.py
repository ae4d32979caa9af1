"""Connected components of an edge table, on Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import staged


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free checksum of the edges."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def _linked_to_smallest(pairs: DataFrame, keep) -> DataFrame:
    """Every neighbour of a vertex linked to the smallest one; hubs are reduced by a combined minimum, never gathered."""
    smallest = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return pairs.join(smallest, "u").where(keep).select(F.col("v").alias("a"), F.col("m").alias("b"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(vertex, component): the smallest vertex reachable, for every vertex that has an edge.

    ``edges`` has two columns of vertices.  Alternating large-star and small-star
    steps; each round is written to the shared folder, so lineage stays short.
    """
    first, second = edges.columns[:2]
    pairs = edges.select(F.greatest(first, second).alias("a"), F.least(first, second).alias("b")).where("a <> b").distinct()
    current = staged(pairs, "edges")
    before = None
    for _ in range(max_rounds):
        now = _mark(current)
        if now == before:
            break
        before = now
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            current.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = _linked_to_smallest(both, F.col("v") > F.col("u")).where("a <> b").distinct()
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        smallest = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(smallest, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            smallest.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
        current = staged(small.where("a <> b").distinct(), "edges")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = current.select(F.col("b").alias("vertex")).distinct().withColumn("component", F.col("vertex"))
    return current.select(F.col("a").alias("vertex"), F.col("b").alias("component")).unionByName(roots)
