"""Connected components of a graph given as edges, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlake.workspace import materialize


def _links(edges: DataFrame, larger: str, smaller: str) -> DataFrame:
    return edges.select(F.col(larger).alias("u"), F.col(smaller).alias("v"))


def _fingerprint(edges: DataFrame) -> tuple:
    mix = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mix)).first())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node, component: the smallest node reachable, for every node of an edge but the roots.

    Roots are not listed, since they are their own component; self-links and NULL ends are no links. Each
    round hangs every node's neighbours below its smallest neighbour, first the larger ones,
    then the smaller ones, until the edges are stars. Rounds are written to the shared
    folder. A node with very many neighbours is met only in aggregates, which each task begins on
    its own, and in joins that adaptive execution splits.
    """
    ends = edges.dropna(subset=[a, b]).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    ends = ends.where("u > v")
    current = materialize(ends.distinct(), "edges")
    before = _fingerprint(current)
    while before[0]:
        both = current.unionByName(_links(current, "v", "u"))
        lowest = both.groupBy("u").agg(F.min("v").alias("low"))
        large = both.where("v > u").join(lowest, "u")
        large = large.select(F.col("v").alias("u"), F.least("u", "low").alias("v"))
        large = materialize(large.where("u > v").distinct(), "edges")
        lowest = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(lowest, "u").where("v <> low")
        small = small.select(F.col("v").alias("u"), F.col("low").alias("v"))
        small = small.unionByName(lowest.select("u", F.col("low").alias("v")))
        current = materialize(small.distinct(), "edges")
        after = _fingerprint(current)
        if after == before:
            break
        before = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
