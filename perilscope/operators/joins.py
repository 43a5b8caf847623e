"""Lookup joins that neither lose nor multiply rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of a lookup side that may be sent to every executor. Wider or longer sides are shuffled.
BROADCAST_ROWS = 500_000


def one_row_per_key(dim: DataFrame, keys: Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """Keep the row with the greatest ``prefer`` values (then the greatest remaining values) per key.

    The grouping also tells Catalyst that the key is unique, so a left join whose columns nobody reads is
    dropped from the plan.
    """
    rest = list(prefer) + [c for c in dim.columns if c not in keys and c not in prefer]
    if not rest:
        return dim.groupBy(*keys).agg()
    picked = dim.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*dim.columns)


def broadcast_if_small(dim: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting at most ``max_rows + 1`` rows; beyond that the join shuffles."""
    return F.broadcast(dim) if dim.limit(max_rows + 1).count() <= max_rows else dim


def lookup_join(facts: DataFrame, dim: DataFrame, on: Sequence[str] | Column) -> DataFrame:
    """Left join: facts are never dropped. Sizes of file-backed lookups are known to Catalyst, which picks
    the broadcast itself and falls back to a shuffle join."""
    return facts.join(dim, on, "left")


def match_rate(facts: DataFrame, dim: DataFrame, keys: Sequence[str], floor: float = 0.9) -> DataFrame:
    """Rows, matched rows and rate of a lookup; ``ok`` says whether the floor is met."""
    marked = facts.join(dim.select(*keys).distinct().withColumn("_hit", F.lit(1)), list(keys), "left")
    counts = marked.agg(F.count(F.lit(1)).alias("rows"), F.count("_hit").alias("matched"))
    rate = F.try_divide(F.col("matched").cast("double"), F.col("rows").cast("double"))
    return counts.withColumn("match_rate", F.round(rate, 6)).withColumn("ok", F.col("match_rate") >= F.lit(floor))


def orphans(facts: DataFrame, parent: DataFrame, column: str, parent_column: str) -> DataFrame:
    """Rows whose non-NULL key is absent from the parent."""
    keys = parent.select(F.col(parent_column).alias(column)).filter(F.col(column).isNotNull())
    return facts.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")
