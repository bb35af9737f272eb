"""Connected components by alternating large-star and small-star steps.

Both steps are one group-by (with map-side minimum) and one join, so a node with
very many links is never gathered in one task.  Each round is written with
``checkpoint()``; the loop ends when a round changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _digest(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"] or 0


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return (both.where("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` with a > b."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """node and root (the least node of its component) of every node in ``links`` (a, b)."""
    links = (links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
             .distinct().checkpoint())
    before = _digest(links)
    while before[0]:
        links = _small_star(_large_star(links)).checkpoint()
        now = _digest(links)
        if now == before:
            break
        before = now
    return (links.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))
