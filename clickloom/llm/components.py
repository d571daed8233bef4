"""Connected components of a link table, of any size and shape.

Rounds of two steps turn the links into stars: first every larger neighbour of a node is linked to
the node's smallest neighbour, then every smaller one is. Both steps are joins with one row per node,
so a node with very many links is split by adaptive execution. The links of a round are written to
the shared folder, which ends their lineage; only two sums come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.frames import written


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in `links` (columns a, b) that isn't its component's smallest.

    `component` is the smallest id that can be reached. No links give no rows.
    """
    now = written(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    state = _state(now)
    while state[0]:
        before = state
        now = written(_small_stars(_large_stars(now)), "links")
        state = _state(now)
        if state == before:
            break
    return now.select(F.col("a").alias("id"), F.col("b").alias("component"))


def _state(links: DataFrame) -> tuple:
    """Number of links and a sum over them: when both stay, the links do."""
    return tuple(links.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first())


def _large_stars(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low"))
    least = least.select("a", F.least("a", "low").alias("low"))
    # Rows with b > a; low is a itself or smaller, so the new link goes down.
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_stars(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("low"))
    down = links.join(least, "a").where("b <> low").select(
        F.col("b").alias("a"), F.col("low").alias("b")
    )
    return down.unionByName(least.select("a", F.col("low").alias("b"))).distinct()
