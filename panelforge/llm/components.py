"""Connected components of a link table by alternating star contraction.

Each round replaces the links of a node by links to the smallest neighbour
(first for larger neighbours, then for smaller ones), which keeps the
components and ends in stars in a number of rounds logarithmic in the size of
a component. Minima are partial aggregates and the joins back are ordinary
shuffle joins, so a node with very many links is split by the skew handling.
Nothing of the links comes to the driver but two counts a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where(F.col("v") > F.col("u")).join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Links have u > v here and in the result."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v): root is the smallest node of its component."""
    checkpoint_dir(links.sparkSession)
    stars = (links.where(F.col("u") != F.col("v"))
             .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint())
    while True:
        n, nodes = stars.agg(F.count("u"), F.count_distinct("u")).first()
        if n == nodes and stars.join(stars.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            break
        stars = _small_star(_large_star(stars)).checkpoint()
    return (stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionAll(stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
