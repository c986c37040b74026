"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # stored, so that both sides of the join are plain exchanges that can be split at a hot node
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")), "stars")
    return (
        both.join(least, "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest neighbour."""
    least = stored(links.groupBy("u").agg(F.min("v").alias("m")), "stars")
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple:
    row = links.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node with a link, root being the smallest node of its component.

    ``links`` has two long columns u and v; direction, repeats and self-links do not matter. Each
    round is written to the shared folder, so neither plans nor lineage grow, and the number of
    rounds grows with the logarithm of the longest chain.
    """
    now = stored(
        links.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "links",
    )
    state = _state(now)
    while state[0]:
        now = stored(_small_star(stored(_large_star(now), "links")), "links")
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
