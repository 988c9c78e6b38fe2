"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Shared


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    near = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return near.union(least.select("u", F.col("m").alias("v"))).distinct()


def _stars(e: DataFrame) -> bool:
    """Whether every larger end ``u`` has one edge and is the lesser end ``v`` of none."""
    ends = e.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("v", F.lit(0), F.lit(1)))
    ends = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def merged(comp: DataFrame, more: DataFrame) -> DataFrame:
    """Edges with the components of those that ``comp``, a result of ``components``, was made of and of ``more``."""
    return comp.where("id <> component").select(F.col("id").alias("u"), F.col("component").alias("v")).union(more)


def components(edges: DataFrame, shared: Shared) -> DataFrame:
    """(id, component) of every endpoint of ``edges`` (u, v); a component is named by its least id.

    Both steps are joins and partial aggregates of the edge table, whose rows
    never grow; a node with very many edges is split by the skew join. The loop
    ends when the edges are stars, which no step changes any more; that takes a
    logarithmic number of rounds. An empty edge table gives an empty result.
    """
    now = shared.put(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    while not _stars(now):
        then = shared.put(_small_star(_large_star(now)), "edges")
        shared.drop(now)
        now = then
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
