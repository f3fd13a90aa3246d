"""Connected components by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node on an edge; component is the smallest node that it reaches.

    Neighbour minima come from aggregations with map-side combining and go
    back by joins whose other side is unique, so a node with very many edges
    is one row per task and no neighbourhood is gathered. The number
    of rounds grows with the logarithm of the longest chain; each round is written to the shared
    folder, which cuts its lineage, and the round before is removed. Null ends and loops are left out, repeated and
    reversed edges count once; without any edge left there are no rows. Extra columns are not read.
    """
    scratch = Scratch(edges.sparkSession, "components")
    pairs = edges.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u"))
    forest = scratch.write(pairs.where(F.col("v") < F.col("u")).distinct(), "forest0")
    was, turn = None, 0
    while (now := _state(forest)) != was:
        if not now[0]:
            break
        was, turn = now, turn + 1
        both = forest.select("u", "v").unionByName(forest.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("v") < F.col("u")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        forest = scratch.write(small.where(F.col("v") < F.col("u")).distinct(), f"forest{turn}")
        scratch.drop(f"forest{turn - 1}")
    roots = forest.select(F.col("v").alias("node")).distinct().join(forest.select(F.col("u").alias("node")), "node", "left_anti")
    labels = forest.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
    labels = scratch.write(labels, "labels")
    scratch.drop(f"forest{turn}")
    return labels
