"""Connected components of a link table by alternating star contraction.

Each round points every node at the smallest id among its neighbours, first for
larger neighbours and then for smaller ones, until nothing changes. Rounds grow
with the logarithm of the longest chain. Nothing is collected but one count and
one checksum per round; each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
    larger = both.filter("b > a").join(lowest, "a")
    return larger.select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    lowest = links.groupBy("a").agg(F.min("b").alias("low"))
    moved = links.join(lowest, "a").filter("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(lowest.select("a", F.col("low").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links(a, b)``; the component is its smallest node.

    Self-links and repeated links are ignored, and so are links with a null end.
    """
    links = links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
    links = stored(links, "links")
    seen = None
    while True:
        links = stored(_small_star(_large_star(links)), "links")
        mark = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == seen:
            break
        seen = mark
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
