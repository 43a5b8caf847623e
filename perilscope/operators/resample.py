"""Targeted minority oversampling (SMOTE, Chawla et al. 2002) with exact nearest neighbours.

Neighbours are found without pairing all rows. Equal points are merged and carry a multiplicity. Points are
ordered by a one-dimensional projection whose differences never exceed the true distance, and cut into blocks
of at most ``BLOCK`` points. A point looks at its own block and the two beside it, and then at the blocks whose box is
within the distance found so far. Each task compares one block with one block.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilscope.functions.scalars import hash_fraction
from perilscope.operators.prefix import positions, running_sums
from perilscope.session import cut_lineage

BLOCK = 256
CHUNK = 10_000
FOUND = "id bigint, other bigint, copies bigint, distance double"


def merged_points(minority: DataFrame, features: Sequence[str]) -> DataFrame:
    """Distinct points: id in projection order, coordinates ``x``, copies, projection ``p``, block."""
    merged = minority.groupBy(*features).agg(F.count(F.lit(1)).alias("copies"))
    total = F.lit(0.0)
    for c in features:
        total = total + F.col(c).cast("double")
    merged = cut_lineage(merged.withColumn("p", total / math.sqrt(len(features))))
    placed = positions(merged, [], "p", "id", then=list(features))
    coordinates = F.array(*[F.col(c).cast("double") for c in features]).alias("x")
    block = F.floor((F.col("id") - 1) / BLOCK).cast("bigint").alias("block")
    return cut_lineage(placed.select("id", "copies", "p", block, coordinates))


def _compare_blocks(k: int):
    def compare(asking: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        if asking.empty or offered.empty:
            return pd.DataFrame({"id": [], "other": [], "copies": [], "distance": []})
        a, b = np.stack(asking["x"].to_list()), np.stack(offered["y"].to_list())
        distance = np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2))
        near = np.argsort(distance, axis=1, kind="stable")[:, : k + 1]
        rows = np.repeat(np.arange(len(a)), near.shape[1])
        picked = near.ravel()
        return pd.DataFrame(
            {
                "id": asking["id"].to_numpy()[rows],
                "other": offered["other"].to_numpy()[picked],
                "copies": offered["copies"].to_numpy()[picked],
                "distance": distance[rows, picked],
            }
        )

    return compare


def _nearest(found: DataFrame, k: int) -> DataFrame:
    """Per point the k + 1 nearest distinct points seen (itself included) and the distance at which k rows
    besides the point itself are reached."""
    near = F.slice(F.array_sort(F.collect_list(F.struct("distance", "other", "copies"))), 1, k + 1)
    grouped = found.groupBy("id").agg(near.alias("near"))
    places = F.sequence(F.lit(1), F.size("near"))
    reach = F.transform(
        places,
        lambda i: F.struct(
            F.aggregate(F.slice("near", 1, i), F.lit(0).cast("bigint"), lambda a, n: a + n["copies"]).alias("rows"),
            F.get(F.col("near"), i - 1)["distance"].alias("distance"),
        ),
    )
    enough = F.filter(reach, lambda r: r["rows"] > k)
    return grouped.withColumn("kth", F.get(enough, F.lit(0))["distance"])


def _block_bounds(points: DataFrame, dimensions: int) -> DataFrame:
    """block, low and high of the projection, and the box around its points (least, most)."""
    sides = {
        name: F.array(*[side(F.get("x", F.lit(i))) for i in range(dimensions)]).alias(name)
        for name, side in (("least", F.min), ("most", F.max))
    }
    return points.groupBy("block").agg(F.min("p").alias("low"), F.max("p").alias("high"), *sides.values())


def _compared(points: DataFrame, asking: DataFrame, k: int) -> DataFrame:
    """The k + 1 nearest points that each asking row (id, x, block, other_block) finds in its other block."""
    wanted = asking.select("block", "other_block").distinct()
    offered = points.select(F.col("block").alias("other_block"), F.col("id").alias("other"), "copies", F.col("x").alias("y"))
    offered = offered.join(wanted, "other_block").select(
        F.col("block").alias("a_block"), F.col("other_block").alias("b_block"), "other", "copies", "y"
    )
    pairs = asking.select("block", "other_block", "id", "x").groupBy("block", "other_block")
    return pairs.cogroup(offered.groupBy("a_block", "b_block")).applyInPandas(_compare_blocks(k), FOUND)


def _blocks_within(bounds: DataFrame, radius: DataFrame) -> DataFrame:
    """(block, other_block, least, most): blocks whose box is within the radius of the box of another one.

    Blocks are in projection order, so those within a radius along it are one run of numbers; its ends are found by counting
    over the block borders (one row per block). Boxes then drop what only looks near along the projection.
    """
    reach = bounds.join(radius, "block")
    finite = lambda c: F.greatest(F.least(c, F.lit(1e308)), F.lit(-1e308))  # noqa: E731  a radius may be infinite
    sought = reach.select("block", finite(F.col("low") - F.col("radius")).alias("from"), finite(F.col("high") + F.col("radius")).alias("to"))
    none = F.lit(None).cast("bigint")
    marks = bounds.select(F.col("high").alias("v"), F.lit(1).alias("f"), F.lit(0).alias("l"), F.lit(2).alias("kind"), none.alias("block"))
    marks = marks.union(bounds.select("low", F.lit(0), F.lit(1), F.lit(0), none))
    marks = marks.union(sought.select("from", F.lit(0), F.lit(0), F.lit(1), "block")).union(sought.select("to", F.lit(0), F.lit(0), F.lit(1), "block"))
    counted = running_sums(cut_lineage(marks), [], "v", {"first": F.col("f"), "last": F.col("l")}, then=["kind"])
    ends = counted.filter("kind = 1").groupBy("block").agg(F.min("first").alias("first"), (F.max("last") - 1).alias("last"))
    runs = ends.select("block", F.explode(F.sequence("first", "last")).alias("other_block"))
    runs = runs.filter(F.abs(F.col("block") - F.col("other_block")) > 1)
    mine = reach.select("block", "radius", F.col("least").alias("a_least"), F.col("most").alias("a_most"))
    theirs = bounds.select(F.col("block").alias("other_block"), "least", "most")
    paired = runs.join(mine, "block").join(theirs, "other_block")
    return paired.filter(_gap("a_least", "a_most", "least", "most") <= F.col("radius")).select("block", "other_block", "least", "most")


def _gap(a_least: str, a_most: str, b_least: str, b_most: str) -> Column:
    """Distance between two boxes; a point is a box of its own. Shortened by a trifle, so that rounding loses nothing."""
    apart = F.zip_with(
        F.arrays_zip(F.col(a_least).alias("l"), F.col(a_most).alias("m")),
        F.arrays_zip(F.col(b_least).alias("l"), F.col(b_most).alias("m")),
        lambda a, b: F.greatest(b["l"] - a["m"], a["l"] - b["m"], F.lit(0.0)),
    )
    return F.sqrt(F.aggregate(apart, F.lit(0.0), lambda total, d: total + d * d)) * (1 - 1e-12)


def nearest_points(points: DataFrame, k: int) -> DataFrame:
    """(id, near): exact k nearest rows of every merged point, in two comparisons whatever the data.

    A point first looks at its own block and the two beside it. The distance that gives it k rows bounds where nearer ones can
    be: only blocks whose box is within it are compared then.
    """
    dimensions = points.select(F.size("x").alias("n")).first()
    bounds = cut_lineage(_block_bounds(points, dimensions["n"] if dimensions else 1))
    steps = F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))
    beside = points.select("id", "x", "block", steps.alias("step")).withColumn("other_block", F.col("block") + F.col("step"))
    beside = beside.join(bounds.select(F.col("block").alias("other_block")), "other_block", "left_semi")
    near = cut_lineage(_nearest(_compared(points, beside, k), k))
    bounded = points.select("id", "x", "block").join(near.select("id", "kth"), "id")
    bounded = cut_lineage(bounded.withColumn("kth", F.coalesce("kth", F.lit(float("inf")))))
    radius = bounded.groupBy("block").agg(F.max("kth").alias("radius"))
    further = bounded.join(_blocks_within(bounds, radius), "block")
    further = further.filter(_gap("x", "x", "least", "most") <= F.col("kth"))
    found = near.select("id", F.inline("near")).select("id", "other", "copies", "distance")
    return _nearest(_compared(points, cut_lineage(further.select("id", "x", "block", "other_block")), k).unionByName(found), k)


def synthetic_rows(
    minority: DataFrame, features: Sequence[str], wanted: int, k: int = 5, seed: int = 42
) -> DataFrame:
    """``wanted`` points on the segments between minority rows and their neighbours.

    Every minority row gives the same number of points, the first rows in projection order one more. The
    points of one merged group are made in chunks, so a heavy group is spread over tasks.
    """
    features = list(features)
    points = merged_points(minority, features)
    rows = points.agg(F.sum("copies")).first()[0] or 0
    if wanted <= 0 or rows < 2:
        return minority.select(*[F.col(c).cast("double").alias(c) for c in features]).limit(0)
    near = nearest_points(points, k)
    each, more = divmod(wanted, rows)
    ranged = running_sums(points.select("id", "copies", "x"), [], "id", {"upto": F.col("copies")})
    extra = F.least(F.col("upto"), F.lit(more)) - F.least(F.col("upto") - F.col("copies"), F.lit(more))
    due = ranged.select("id", "copies", "x", (F.col("copies") * each + extra).alias("due")).join(near, "id")
    # Neighbour rows in order of distance, copies repeated, the row itself taken out once.
    others = F.flatten(
        F.transform(
            "near",
            lambda n: F.array_repeat(
                n["other"], F.least(n["copies"] - (n["other"] == F.col("id")).cast("int"), F.lit(k)).cast("int")
            ),
        )
    )
    due = due.withColumn("others", F.slice(others, 1, k)).filter(F.col("due") > 0)
    chunks = due.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("due") - 1) / CHUNK))))
    chunks = chunks.repartition("id", "chunk")
    first = F.col("chunk") * CHUNK
    made = chunks.withColumn("j", F.explode(F.sequence(first, F.least(F.col("due"), first + CHUNK) - 1)))
    slot = F.pmod(F.xxhash64("id", "j", F.lit(seed)), F.size("others")).cast("int")
    made = made.select("id", "x", F.get("others", slot).alias("other"), hash_fraction(F.col("id"), F.col("j"), F.lit(seed + 1)).alias("u"))
    ends = points.select(F.col("id").alias("other"), F.col("x").alias("y"))
    line = made.join(ends, "other").withColumn(
        "z", F.zip_with("x", "y", lambda a, b: a + F.col("u") * (b - a))
    )
    return line.select(*[F.get("z", F.lit(i)).alias(c) for i, c in enumerate(features)])


def targeted_smote(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    category: str,
    targets: Sequence[str],
    ratio: float = 0.1,
    k: int = 5,
    seed: int = 42,
) -> DataFrame:
    """Rows (features, label) of all categories, plus synthetic positives made from the target categories until
    positives reach ``ratio`` of the negatives there. Untouched rows are passed through."""
    chosen = df.filter(F.col(category).isin(*targets))
    counts = chosen.agg(F.count_if(F.col(label) == 1).alias("n1"), F.count_if(F.col(label) == 0).alias("n0")).first()
    wanted = int(ratio * counts["n0"]) - counts["n1"]
    made = synthetic_rows(chosen.filter(F.col(label) == 1), features, wanted, k, seed)
    original = df.select(*[F.col(c).cast("double").alias(c) for c in features], label)
    return original.unionByName(made.withColumn(label, F.lit(1).cast(df.schema[label].dataType)))
