"""Connected components of a graph of any size by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremeld.llm.shared import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that an edge (a, b) of longs touches; the root is the smallest node of its component.

    Every round links each node's larger neighbours, then its smaller ones, to the smallest node it knows, until nothing
    changes; chains halve, so rounds grow with the logarithm of a component's diameter. Minima are combined before the
    shuffle, and the join on a node with many neighbours is one that adaptive execution splits.
    """

    def with_smallest(pairs: DataFrame) -> DataFrame:
        return pairs.join(pairs.groupBy("u").agg(F.min("v").alias("least")), "u")

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    ordered = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    pairs = stored(ordered, "links")
    before = state(pairs)
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            with_smallest(both)
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("least", "u").alias("v"))
            .distinct()
        )
        large = stored(large, "large-star")
        small = (
            with_smallest(large)
            .select(F.explode(F.array(F.struct("u", F.col("least").alias("v")), F.struct(F.col("v").alias("u"), F.col("least").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        pairs = stored(small, "small-star")
        after = state(pairs)
        if after == before:
            break
        before = after
    stars = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
