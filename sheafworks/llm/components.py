"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafworks.session import scratch_path

from .common import write_once


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b); root is the smallest node of its component.

    Each round moves every neighbour to the smallest node in reach; the rounds grow with the
    logarithm of the longest chain. Smallest neighbours are a partial aggregate, and the joins
    may be split by the adaptive planner, so a node with very many links is no hot task. Each
    round is a table in the shared folder. Links from a node to itself and nulls are left out.
    """
    spark = links.sparkSession
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = write_once(edges, scratch_path(spark, "links"))
    before = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1000003)).first()
        if now[0] == 0 or now == before:
            break
        before = now
        edges = write_once(_small_star(_large_star(edges)), scratch_path(spark, "links"))
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(stars.select(F.col("root"), F.col("root")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest one in its reach."""
    both = edges.union(edges.select(F.col("b"), F.col("a"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links every smaller neighbour of a node, and the node, to the smallest one."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
