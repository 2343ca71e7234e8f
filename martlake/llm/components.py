"""Connected components of a table of links, by alternating star contractions.

Every node is linked to its smallest neighbour, first by its larger neighbours and then by its smaller ones, until
nothing changes; the number of rounds grows with the logarithm of the longest path.  Links and minima are written
each round, so that a lost executor repeats one round at most, and a node with very many links is one side of a plain
join that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links: (u, v) with u > v."""
    if large:
        near = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        out = near.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = written(links.groupBy("u").agg(F.min("v").alias("m")), "least")
        out = links.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
    return written(out.where("u > v").distinct(), "links")


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node that can be reached) of every node that has a link; ``links``: a, b long."""
    links = written(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .distinct(), "links")
    state = _state(links)
    while state[0]:
        links = _star(_star(links, True), False)
        if (new := _state(links)) == state:
            break
        state = new
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
