"""Repeatable samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def seeded_sample(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """The ``n`` rows with the smallest seeded MD5 of their keys: independent of partitioning, and a top-n per task.

    MD5 has a counterpart in every SQL engine, so the sample can be repeated elsewhere.
    """
    parts = [F.coalesce(F.col(key).cast("string"), F.lit("")) for key in keys]
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))
    return df.withColumn("_h", order).orderBy("_h", *keys).limit(n).drop("_h")


def peek(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows by key."""
    return df.orderBy(*keys).limit(n)
