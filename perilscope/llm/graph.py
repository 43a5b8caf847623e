"""Connected components of a large graph, labelled by the smallest node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilscope.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """node, component for each node of ``edges`` (a, b: bigint, not NULL, any order and repeats).

    Alternates two steps until nothing changes: every node hands its smallest neighbour to its larger neighbours, then
    to its smaller ones. Both keep the components and end in stars around the smallest nodes, after about log(n) rounds.
    Minima are partial aggregations and the join on a hot node can be split by AQE; each round is stored.
    """
    links = cut_lineage(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    state = None
    while True:
        links = cut_lineage(smaller_step(larger_step(links)))
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    leaves = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.union(links.select("v", "v").distinct())


def larger_step(links: DataFrame) -> DataFrame:
    """(u, v), u > v: every node links its larger neighbours to the smallest of its neighbours and itself."""
    both = links.union(links.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    larger = links.select(F.col("v").alias("u"), F.col("u").alias("w"))
    return larger.join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()


def smaller_step(links: DataFrame) -> DataFrame:
    """(u, v), u > v: every node links itself and its smaller neighbours to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", "m")).distinct()
