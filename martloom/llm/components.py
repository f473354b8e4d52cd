"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import stored


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(a, root) for every node ``a`` of ``links`` (a, b: long); root is the smallest node it is connected with.

    A round hangs every larger neighbour of a node on the smallest one, then every smaller one; the tables stay at one row
    per node and link, are written each round, and the rounds grow with the logarithm of the nodes. Minima are aggregated before
    they are joined back, so that a node with a large part of all links is split by the adaptive skew join. Loops,
    repeated links and NULL ends are dropped. No links: no rows.
    """
    links = links.filter("a is not null and b is not null and a <> b")
    links = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = _mark(links)
    while True:
        both = _both_ways(links)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        links = stored(small.filter("a <> b").distinct(), "small-star")
        now = _mark(links)
        if now == mark:
            return links.select("a", F.col("b").alias("root")).union(links.select(F.col("b").alias("a"), F.col("b").alias("root")).distinct())
        mark = now
