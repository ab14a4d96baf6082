"""Connected components of a graph given as a table of links, by alternating stars.

Every round replaces each node's links by links to the smallest node it knows: first for its larger
neighbours, then for its smaller ones. Only aggregated minima and equi-joins are used, so a node with very many
links is a skewed key that Spark splits, never a group in one task. Rounds grow with the logarithm of a
component's size. Each round's links are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.session import written


def _stars(pairs: DataFrame, larger: bool) -> DataFrame:
    """Link each node's neighbours to the smallest node next to it (itself included)."""
    least = pairs.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    joined = pairs.join(least, "a")
    if larger:
        return joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    return joined.select(F.col("b").alias("a"), F.col("least").alias("b")).union(own)


def _marks(links: DataFrame) -> tuple:
    hashed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(links.agg(F.count("*"), F.sum(hashed)).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): each node that has a link to another one, with the smallest node of its component.

    Links with a null end and links of a node to itself say nothing and are left out; repeated links count once.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter(F.col("a") != F.col("b"))
    links = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while (now := _marks(links)) != before:
        before = now
        if not now[0]:
            break
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _stars(both, larger=True).filter(F.col("a") != F.col("b")).distinct()
        small = _stars(large, larger=False).filter(F.col("a") != F.col("b"))
        small = small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        links = written(small, "links")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
