"""Connected components of a graph of links, by alternating stars.

Each round hangs all larger neighbours of a node on its smallest one, then all smaller
ones. Nothing but a few counts reaches the driver. A node with very many links is one
skewed key of a join, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskwright.llm.tables import stored


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every node of ``links``, whose two columns hold bigint ids.

    ``component`` is the smallest id that can be reached. Links of a node to itself, nulls
    and repeated links change nothing.
    """
    u, v = links.columns
    edges = stored(
        links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
        .filter("u <> v")
        .distinct(),
        "stars",
    )
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = _small(_large(both))
        edges = stored(edges, "stars")
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum("v")
        ).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def _large(both: DataFrame) -> DataFrame:
    """Every larger neighbour of u with the smallest of u and its neighbours."""
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    larger = both.filter("v > u").join(lowest, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """u and every smaller neighbour of u with the smallest of them."""
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    smaller = edges.join(lowest, "u").filter("v <> m")
    return (
        smaller.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(lowest.select("u", F.col("m").alias("v")))
        .distinct()
    )
