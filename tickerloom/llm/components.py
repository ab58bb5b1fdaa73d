"""Connected components of a table of links, in rounds of aggregates and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.session import through_table


def _mark(links: DataFrame) -> tuple:
    """A value that two equal sets of links share; ``decimal`` sums can't overflow."""
    return tuple(links.agg(
        F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)")), F.sum(F.xxhash64("root", "node").cast("decimal(38,0)")),
    ).first())


def connected(links: DataFrame) -> DataFrame:
    """(node, root): every node of ``links`` (columns a, b: long) with the smallest node it can reach.

    Large-star and small-star in turn: each hooks neighbours to the smallest node known, until nothing changes, in a
    number of rounds that grows with the logarithm of the longest chain. Minima are aggregates with map-side combine,
    stored, and come back by a join of two stored tables, which Spark can split, so a node with very many links is no hot
    group. Every round is a stored table. Roots that link to nothing else are returned as their own root.
    """
    now = through_table(
        links.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct(),
        "links",
    )
    before = None
    while (mark := _mark(now)) != before:
        before = mark
        both = now.unionByName(now.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = through_table(
            both.groupBy("node").agg(F.min("root").alias("low")).select("node", F.least("node", "low").alias("low")), "least")
        large = (
            both.join(least, "node").where("root > node").select(F.col("root").alias("node"), F.col("low").alias("root"))
            .where("node <> root").distinct()
        )
        large = through_table(large, "large-star")
        least = through_table(large.groupBy("node").agg(F.min("root").alias("low")), "least")
        small = (
            large.join(least, "node")
            .select(F.col("root").alias("node"), F.col("low").alias("root")).where("node <> root")
            .unionByName(least.select("node", F.col("low").alias("root"))).distinct()
        )
        now = through_table(small, "small-star")
    ends = now.select("node", "root")
    return ends.unionByName(now.select(F.col("root").alias("node"), "root").distinct())
