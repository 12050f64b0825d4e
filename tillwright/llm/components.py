"""Connected components by alternating large-star and small-star steps.

Links shrink towards stars around the smallest node. Each step is joins and
map-side combined minima; its links are written to the shared folder, which cuts
the lineage and survives lost executors. Nothing but a count and a checksum
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.session import durable


def _lowest(pairs: DataFrame) -> DataFrame:
    """Per node u of (u, v): the lower one of u and its lowest v."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _stars(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step on links (hi, lo), hi > lo."""
    both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    large = both.join(_lowest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
    lowest = _lowest(large)
    small = large.join(lowest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.union(lowest.select("u", F.col("m").alias("v"))).distinct().select(F.col("u").alias("hi"), F.col("v").alias("lo"))


def _checksum(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b) that is not the lowest of its component."""
    current = durable(links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    seen = _checksum(current)
    while seen[0]:
        current = durable(_stars(current))
        now = _checksum(current)
        if now == seen:
            break
        seen = now
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
