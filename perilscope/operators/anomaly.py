"""Isolation forest (Liu, Ting & Zhou 2008) at any row grain.

Trees are grown in parallel, one group of at most 256 sampled rows each. The forest is small and bounded
(trees x 511 nodes), so it is sent to every task; scoring all rows is the distributed part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perilscope.functions.scalars import hash_fraction
from perilscope.operators.prefix import quantile_value
from perilscope.operators.scaling import fit_scaling, scale
from perilscope.session import cut_lineage

TREES = 100
BAG = 256
NODE_SCHEMA = "tree int, node int, feature int, cut double, below int, above int, depth double"


def expected_depth(n: float) -> float:
    """Mean path length of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def _grow(features: list[str], limit: int, seed: int, size: int):
    # Everything the tasks need is captured here, so executors need no copy of this package.
    leaf_depth = [expected_depth(n) for n in range(size + 1)]
    names = [part.split()[0] for part in NODE_SCHEMA.split(", ")]

    def grow(bag: pd.DataFrame) -> pd.DataFrame:
        tree = int(bag["tree"].iloc[0])
        points = bag.sort_values("order")[features].to_numpy(dtype=float)
        rng = np.random.default_rng([seed, tree])
        nodes, open_nodes = [], [(0, points, 0)]
        made = 1
        while open_nodes:
            node, inside, level = open_nodes.pop()
            low, high = inside.min(axis=0), inside.max(axis=0)
            splittable = np.flatnonzero(high > low)
            if level >= limit or len(inside) <= 1 or len(splittable) == 0:
                nodes.append((tree, node, -1, 0.0, -1, -1, level + leaf_depth[len(inside)]))
                continue
            feature = int(rng.choice(splittable))
            cut = float(rng.uniform(low[feature], high[feature]))
            left = inside[:, feature] < cut
            nodes.append((tree, node, feature, cut, made, made + 1, 0.0))
            open_nodes += [(made, inside[left], level + 1), (made + 1, inside[~left], level + 1)]
            made += 2
        return pd.DataFrame(nodes, columns=names)

    return grow


def grow_forest(
    df: DataFrame, features: Sequence[str], keys: Sequence[str], trees: int = TREES, bag: int = BAG, seed: int = 42
) -> tuple[DataFrame, int]:
    """Node table and bag size. Bags are drawn by key hash, so they do not depend on partitioning.

    Each tree has its own hash of every row, so any row can be in any tree, independently of the other trees. A row is
    only expanded for the trees in which its hash is among the lowest, four times as many as a bag needs.
    """
    features = list(features)
    rows = df.count()
    size = min(bag, rows)
    share = min(1.0, 4.0 * bag / max(rows, 1))
    numbers = F.sequence(F.lit(0), F.lit(trees - 1))
    mine = F.filter(numbers, lambda tree: hash_fraction(tree, *keys, F.lit(seed + 1)) < share)
    drawn = df.select(*keys, *features, F.explode(mine).alias("tree"))
    drawn = drawn.withColumn("order", F.xxhash64("tree", *keys, F.lit(seed)))
    smallest = Window.partitionBy("tree").orderBy("order", *keys)
    bags = drawn.withColumn("_n", F.row_number().over(smallest)).filter(F.col("_n") <= size)
    limit = math.ceil(math.log2(max(size, 2)))
    nodes = bags.select("tree", "order", *features).groupBy("tree").applyInPandas(
        _grow(features, limit, seed, size), NODE_SCHEMA
    )
    return nodes, size


def score_forest(df: DataFrame, nodes: DataFrame, features: Sequence[str], size: int, out: str) -> DataFrame:
    """Score in (-1, 0); lower is more anomalous."""
    features = list(features)
    table = nodes.orderBy("tree", "node").toPandas()
    trees = [t.set_index("node").sort_index() for _, t in table.groupby("tree")]
    packed = [tuple(t[c].to_numpy() for c in ("feature", "cut", "below", "above", "depth")) for t in trees]
    forest = df.sparkSession.sparkContext.broadcast(packed)
    normal = expected_depth(size) or 1.0

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = batch[features].to_numpy(dtype=float)
            index = np.arange(len(points))
            depth = np.zeros(len(points))
            for feature, cut, below, above, leaf_depth in forest.value:
                at = np.zeros(len(points), dtype=int)
                while True:
                    f = feature[at]
                    moving = f >= 0
                    if not moving.any():
                        break
                    down = points[index, np.maximum(f, 0)] < cut[at]
                    at = np.where(moving, np.where(down, below[at], above[at]), at)
                depth += leaf_depth[at]
            yield batch.assign(**{out: -np.exp2(-(depth / len(forest.value)) / normal)})

    schema = T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())])
    return df.mapInPandas(score, schema)


def walk_forest(
    df: DataFrame, nodes: DataFrame, features: Sequence[str], keys: Sequence[str], size: int, out: str, levels: int | None = None
) -> DataFrame:
    """``keys`` and the score, by joins: every row goes down all trees at once, one join with the node table per level.

    Slower than ``score_forest``, but a forest of any size takes part as a table.
    """
    keys = list(keys)
    levels = math.ceil(math.log2(max(size, 2))) if levels is None else levels
    values = F.array(*[F.col(c).cast("double") for c in features]).alias("_x")
    trees = nodes.agg(F.sort_array(F.collect_set("tree"))).scalar()
    at = df.select(*keys, values, F.explode(trees).alias("tree")).withColumn("node", F.lit(0))
    for _ in range(levels):
        here = at.join(nodes.drop("depth"), ["tree", "node"])
        goes_down = F.get("_x", F.col("feature")) < F.col("cut")
        following = F.when(F.col("feature") < 0, F.col("node")).when(goes_down, F.col("below")).otherwise(F.col("above"))
        at = here.select(*keys, "_x", "tree", following.alias("node"))
    ended = at.join(nodes.select("tree", "node", "depth"), ["tree", "node"])
    normal = expected_depth(size) or 1.0
    return ended.groupBy(*keys).agg((-F.pow(F.lit(2.0), -F.avg("depth") / normal)).alias(out))


def score_anomalies(
    df: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    contamination: float = 0.1,
    trees: int = TREES,
    seed: int = 42,
) -> DataFrame:
    """log1p, standardise, grow, score and flag the lowest share. ``keys`` identify a row."""
    inner = [f"_{c}" for c in features]
    logged = df.withColumns({i: F.log1p(F.col(c).cast("double")) for i, c in zip(inner, features)})
    logged = cut_lineage(logged)
    ready = scale(logged, fit_scaling(logged, inner))
    nodes, size = grow_forest(ready, inner, keys, trees, seed=seed)
    scored = cut_lineage(score_forest(ready, nodes, inner, size, "anomaly_raw_score").drop(*inner))
    limit = quantile_value(scored, "anomaly_raw_score", contamination)
    flag = F.when(F.col("anomaly_raw_score") <= F.lit(limit), -1).otherwise(1)
    return scored.withColumn("anomaly_score", flag)
