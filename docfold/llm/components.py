"""Connected components of an edge table, without gathering edges or components on the driver.

Alternating large-star and small-star steps turn every component into a star around its smallest member in a number of
rounds that grows with the logarithm of its size.  Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.scratch import Scratch

MAX_ROUNDS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.u", "e.v")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the smallest member of its neighbourhood."""
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return near.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """Stars only: no centre hangs on another, and no member on two."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")), F.struct(F.col("v").alias("x"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))).alias("e"))
    degrees = ends.select("e.*").groupBy("x").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return degrees.where("hangs > 1 or hangs = 1 and holds = 1").isEmpty()


def _stars(edges: DataFrame) -> DataFrame:
    centres = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(centres)


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component) of every id that has an edge; edges are pairs (u, v) of longs, component the smallest id reached."""
    edges = scratch.write(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        new = scratch.write(_small_star(_large_star(edges)), "edges")
        scratch.drop(edges)
        edges = new
        if _settled(edges):
            return _stars(edges)
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
