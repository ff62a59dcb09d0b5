"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.session import stored


def _nearest(links: DataFrame) -> DataFrame:
    """Each node's smallest neighbour or itself, combined before the shuffle."""
    return links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b); root is the smallest node it is connected with.

    Alternates two steps until the links no longer change: every node hands its larger neighbours,
    then its smaller ones, over to the smallest node it knows. That takes a logarithmic number of
    rounds, also for long chains, and never more rows than links. Each round is stored. Joins are on
    plain keys, so adaptive execution splits the rows of a node with very many links.
    """
    now = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = stored(now.filter("u <> v").distinct(), "links")
    before = None
    while True:
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38)"))).first())
        if mark == before:
            break
        before = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_nearest(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.filter("u <> v").distinct(), "large")
        least = _nearest(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v")))
        now = stored(small.filter("u <> v").distinct(), "small")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
