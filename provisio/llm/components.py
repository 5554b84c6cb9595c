"""Connected components by alternating large-star and small-star rounds.

Each round is a partial aggregate (smallest neighbour) and a join with it, so
a hub with a third of the nodes is reduced map-side and its join partition can
be split by adaptive execution. Rounds grow with the logarithm of the longest
path. Every round is written to the shared folder; only two numbers a round
(a count and a checksum) reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import land


def _stars(edges: DataFrame) -> DataFrame:
    """One round over (src, dst): point every node at the smallest one near it."""
    both = edges.select(F.col("src").alias("u"), F.col("dst").alias("v")) \
        .union(edges.select(F.col("dst").alias("u"), F.col("src").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
        .where(F.col("u") != F.col("v")).distinct()
    # now v < u in every row
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(low, "u")
    return small.where(F.col("v") != F.col("m")).select(F.col("v").alias("src"), F.col("m").alias("dst")) \
        .union(low.select(F.col("u").alias("src"), F.col("m").alias("dst"))).distinct()


def component_roots(edges: DataFrame) -> DataFrame:
    """(src, dst): every node that has a link, other than the roots, with the
    smallest node of its component."""
    stars = land(edges.where(F.col("src") != F.col("dst")).select(F.greatest("src", "dst").alias("src"),
                                                                 F.least("src", "dst").alias("dst")).distinct(), "stars")
    seen = None
    while True:
        total = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if tuple(total) == seen or total[0] == 0:
            return stars
        seen = tuple(total)
        stars = land(_stars(stars), "stars")


def smallest_reachable(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root, label): each node's component (its smallest node) and the
    smallest label in it. ``nodes`` has distinct ``node`` with ``label``; a
    node without links is its own component."""
    roots = component_roots(edges)
    rooted = nodes.join(roots.withColumnRenamed("src", "node"), "node", "left") \
        .withColumn("root", F.coalesce("dst", "node")).select("node", "label", "root")
    smallest = rooted.groupBy("root").agg(F.min("label").alias("least"))
    return rooted.join(smallest, "root").select("node", "root", F.col("least").alias("label"))
