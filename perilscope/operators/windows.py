"""Window operators for aggregated (small) results: ranks, shares, lags over the previous present row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def percent_rank_within(df: DataFrame, by: Sequence[str], order: str, out: str, digits: int = 1) -> DataFrame:
    """Rank position 0-100 inside each group, NULL lowest."""
    spec = Window.partitionBy(*by).orderBy(F.col(order).asc_nulls_first())
    return df.withColumn(out, F.round(F.percent_rank().over(spec) * 100, digits))


def previous_values(df: DataFrame, by: Sequence[str], order: str, columns: dict[str, str]) -> DataFrame:
    """Value of the previous row that exists, which need not be the previous calendar period."""
    spec = Window.partitionBy(*by).orderBy(order)
    return df.withColumns({out: F.lag(src).over(spec) for src, out in columns.items()})


def ranks_descending(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Competition rank over the whole frame; meant for an aggregate of a handful of rows."""
    everything = Window.partitionBy()
    return df.withColumns(
        {out: F.rank().over(everything.orderBy(F.col(src).desc_nulls_last())) for src, out in columns.items()}
    )


def share_of_total(df: DataFrame, amount: Column, out: str, digits: int = 2) -> DataFrame:
    """Percentage of the grand total. Totals are exact decimals, so the share does not depend on row order."""
    total = F.sum(amount.cast("decimal(30,2)")).over(Window.partitionBy()).cast("double")
    return df.withColumn(out, F.round(F.try_divide(amount, total) * 100, digits))
