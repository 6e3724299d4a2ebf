"""Connected components of a link table by alternating star contraction.

Every round replaces the links of a node by links to the smallest node it knows (large-star, then
small-star); the links of one node are only reduced to a minimum (a partial aggregate), never
gathered.  Rounds are written to the shared folder, so a lost executor repeats one round at most.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadra.llm.shared import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root): for every node of ``links`` (a, b) the smallest node it reaches."""

    def state(x: DataFrame) -> tuple:
        return tuple(x.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def stars(x: DataFrame) -> DataFrame:
        # large-star: larger neighbours move to the smallest node around (itself included)
        both = x.unionByName(x.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small-star: smaller neighbours and the node itself move to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        return large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).where("a <> b").distinct()

    links = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    known = state(links)
    while known[0]:
        links = stored(stars(links), "links")
        before, known = known, state(links)
        if known == before:
            break
    return links.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node").unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def contracted(stars: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) for ``links`` and ``stars`` (a, b: a belongs to the star of b) together.

    Each node first goes to the smallest centre of its stars; only links between different centres are
    left for the rounds, and these are few where stars are large.
    """
    centre = stored(stars.where("a <> b").groupBy(F.col("a").alias("node")).agg(F.min("b").alias("c")), "centres")

    def moved(x: DataFrame, end: str) -> DataFrame:
        c = centre.select(F.col("node").alias(f"_{end}"), F.col("c").alias(f"_c{end}"))
        return x.join(c, F.col(end) == F.col(f"_{end}"), "left").withColumn(end, F.coalesce(f"_c{end}", end)).select("a", "b")

    # a centre that has a centre itself keeps that link, so nothing is lost by moving its members
    kept = centre.select(F.col("node").alias("a"), F.col("c").alias("b")).join(centre.select(F.col("c").alias("b")).distinct().withColumnRenamed("b", "a"), "a", "left_semi")
    every = moved(moved(stars.select("a", "b").unionByName(links.select("a", "b")), "a"), "b").unionByName(kept)
    root = stored(components(every), "roots")
    leaves = centre.join(root.select(F.col("node").alias("c"), "root"), "c", "left").select("node", F.coalesce("root", "c").alias("root"))
    centres = centre.select(F.col("c").alias("node")).distinct().join(centre.select("node"), "node", "left_anti").join(root, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    rest = root.join(centre.select("node"), "node", "left_anti").join(centre.select(F.col("c").alias("node")).distinct(), "node", "left_anti")
    return leaves.unionByName(centres).unionByName(rest.select("node", "root"))
