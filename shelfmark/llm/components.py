"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfmark.scratch import staged


def _least(edges: DataFrame) -> DataFrame:
    """Replace each edge (u, v) by (v, least neighbour of u) and link u to it as well."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"))
    return edges.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """node, component (least node reachable), for all nodes of `edges` (u, v: long), which may hold repeats.

    Alternates two steps until nothing changes: every node hands its larger neighbours to its least one; every node
    hands its smaller neighbours, and itself, to its least one. Rounds grow with the logarithm of a
    component's size. Each round is written out, narrow, so a lost executor repeats one round. A node with very many
    neighbours only meets them in a join against one row per node, which Spark can split.
    """
    now = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        large = large.where("u <> v").distinct()
        joined = _least(large)
        small = (joined.select(F.col("v").alias("u"), F.col("least").alias("v"))
                 .unionAll(joined.select("u", F.col("least").alias("v"))).where("u <> v").distinct())
        after = staged(small)
        if not _changed(now, after):
            return after.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
                after.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        now = after


def _changed(before: DataFrame, after: DataFrame) -> bool:
    def shape(edges):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    return shape(before) != shape(after)
