"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import stage, unstage


def _stars(links: DataFrame) -> DataFrame:
    """One large and one small star.  Minima are pre-aggregated; hubs meet them in joins that Spark can split."""
    both = links.union(links.select("b", "a"))
    least = both.groupBy(F.col("a").alias("hub")).agg(F.min("b").alias("m")).withColumn("m", F.least("hub", "m"))
    large = both.join(least, F.col("a") == F.col("hub")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
    low = large.groupBy(F.col("a").alias("hub")).agg(F.min("b").alias("m"))
    small = large.join(low, F.col("a") == F.col("hub"))
    return small.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").union(low.select(F.col("hub").alias("a"), F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links (a, b)``; the root is the component's smallest node.

    Each round is written to the shared folder; a component of n nodes takes about log n rounds.
    """
    now = stage(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = None
    while True:
        sum_ = now.agg(F.count("a"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first()
        if sum_ == mark:
            break
        mark, before, now = sum_, now, stage(_stars(now), "links")
        unstage(before)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stage(now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots), "components")
