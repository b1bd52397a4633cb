"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _state(links: DataFrame) -> tuple:
    """Count and two sums that change whenever the set of links does."""
    mixed = F.xxhash64("u", "v")
    return tuple(
        links.agg(
            F.count(F.lit(1)),
            F.sum(F.pmod(mixed, F.lit(1 << 31))),
            F.sum(F.shiftright(mixed, 33)),
        ).first()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (u, v); root is the least node it reaches.

    Alternating large-star and small-star rounds: links shrink towards a star around each
    least node, in about log2 of the number of nodes rounds. Least neighbours are partial
    aggregates, so a node with any number of links is a few rows per task; the join that
    hands them back is skewed at most on its large side, which AQE splits. Every round is
    a written table, so a lost executor costs one round at most.
    """
    links = links.filter("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    links = materialize(links.distinct(), "links")
    before = _state(links)
    while before[0]:
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(least, "u")
            .filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        large = materialize(large.filter("u != v").distinct(), "links")
        # every link now points to a smaller node
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
        )
        links = materialize(small.filter("u != v").distinct(), "links")
        after = _state(links)
        if after == before:
            break
        before = after
    stars = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(links.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
