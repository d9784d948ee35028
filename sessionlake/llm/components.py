"""Connected components of a link table, by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(node, component) for every end of a link (columns a, b); the smallest node names it.

    Each round halves the depth of what remains and ends in a table of the shared
    folder; no step gathers links on the driver, and the links of a hub are never
    all paired.
    """
    scratch = scratch or Scratch(links.sparkSession)
    edges = scratch.table(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = (
            both.join(low, "a").where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a").where(F.col("b") != F.col("m"))
            .select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b")))
            .distinct()
        )
        last, edges = edges, scratch.table(small)
        scratch.drop(last)
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    )
