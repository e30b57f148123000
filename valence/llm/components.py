"""Connected components of a link table, by alternating star contractions in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sinks.writers import stage


def _large_star(links: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest node near it."""
    both = links.select("a", "b").union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Tie every smaller neighbour of a node, and the node, to the smallest of them. Rows hold ``a > b``."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node ``> root`` of the links ``a, b`` (whole numbers, no nulls).

    The root is the smallest node that can be reached. A round shortens all paths
    at once, so their number grows with the logarithm of the longest path. Each
    round is a written table: nothing is collected but one checksum row.
    """
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, seen = stage(ordered, "links"), None
    while True:
        now = stage(_small_star(_large_star(now)), "links")
        row = now.agg(F.count("*"), F.expr("sum(CAST(xxhash64(a, b) AS DECIMAL(38, 0)))")).first()
        if tuple(row) == seen or row[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = tuple(row)
