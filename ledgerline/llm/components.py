"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialised


def _least(pairs: DataFrame) -> DataFrame:
    """Per node ``u`` of ``pairs`` (u, v): m, the least of it and its neighbours; summed up before the shuffle."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = _least(edges)
    inner = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return inner.unionByName(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Per node of ``edges`` (two columns of one ordered type, no nulls): node, root, the least node it is connected with.

    Self-loops and repeated edges change nothing; no edges give no rows. Each round is written to the checkpoint folder,
    so lineage stays short, and nothing but two numbers a round comes to the driver. A node's edges meet its least
    neighbour in a join, whose large partitions Spark splits; no group is held in memory.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    now, before = materialised(now), None
    while True:
        state = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if state == before or state[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select("v", "v").toDF("node", "root")).distinct()
        before = state
        now = materialised(_small_star(_large_star(now).distinct()).distinct())
