"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import written


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is the lower end of links or the upper end of one (links go from u down to v)."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    return (ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
            .where("up > 1 or up = 1 and down = 1").isEmpty())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: longs): root is the least node of its component.

    Alternates large-star and small-star steps until the links are stars: each node hands its larger
    neighbours, then its smaller ones, to the least of them. Links never grow in number, only minima are
    aggregated (partially before the shuffle), and each round is written out."""
    a, b = F.col("a"), F.col("b")
    edges = written(links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
                    "links")
    while not _are_stars(edges):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("w")).withColumn("w", F.least("u", "w"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("w").alias("v")).distinct()
        large = written(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("w"))
        small = large.join(least, "u")
        small = small.where("v > w").select(F.col("v").alias("u"), F.col("w").alias("v")).union(
            least.select("u", F.col("w").alias("v"))).distinct()
        edges = written(small, "small-star")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v"), F.col("v")).distinct())
