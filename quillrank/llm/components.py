"""Connected components of a link table by alternating large-star and small-star steps.

Each step regroups the links by one end and points them at the smallest neighbour; links shrink to stars around the
smallest node of each component in a logarithmic number of rounds. Nothing is gathered per node: minima are aggregates
and links are joined to them. Every round is a written table below the shared folder.

Defined cases: an empty table gives an empty one; self links and repeated links change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillrank.session import stage


def _pointed(links: DataFrame) -> DataFrame:
    """``links`` (u, v) with the smallest v of each u."""
    return links.join(links.groupBy("u").agg(F.min("v").alias("m")), "u")


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node of a link, with the smallest node that it reaches."""
    pair = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    now = stage(pair, "links")
    seen = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _pointed(both).select("u", "v", F.least("u", "m").alias("m")).filter("v > u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _pointed(large)
        hung = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stage(hung.union(small.select("u", F.col("m").alias("v"))).distinct(), "links")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.withColumn("component", F.col("node")))
