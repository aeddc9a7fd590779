"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innlake.session import ensure_checkpoint_dir


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node with the least node next to it."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links the smaller neighbours of a node, and the node, with the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    others = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in the edges (u, v); a component is named by its least node.

    Nulls and loops link nothing. Each round halves paths at least; rounds are
    cut from their lineage in the shared checkpoint folder and compared by a
    digest, one row on the driver. A hub's edges are joined with its least
    neighbour, not gathered, so a hub may be split over tasks.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    digest = [F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")]
    edges = edges.filter("u <> v").select("u", "v").distinct().checkpoint()  # read twice in each round
    before = None
    while True:
        edges = _small_star(_large_star(edges).distinct()).distinct().checkpoint()
        after = edges.agg(*digest).first()
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct())
