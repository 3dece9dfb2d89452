"""Connected components by alternating large and small stars.

Every round is two aggregates and two joins over the links, written to the
shared folder; nothing but a checksum comes to the driver.  The number of
rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import table


def components(links: DataFrame) -> DataFrame:
    """links: a, b (same type, not null).  Returns node, root: each node that
    has a link, with the smallest node that it reaches."""
    links = table(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                  "links")
    seen = None
    while True:
        # large star: a node's larger neighbours go to the least of its neighbourhood
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        # small star: a node and its smaller neighbours go to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        links = table(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    nodes = links.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct())
