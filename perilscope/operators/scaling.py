"""Standardisation with the statistics of one (training) frame, applied as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Where to keep it: a fitted scaling can be a stage of a stored pipeline, see ``scaling_stage``.
Scaling = dict[str, tuple[float, float]]


def fit_scaling(df: DataFrame, columns: Sequence[str]) -> Scaling:
    """Mean and population standard deviation per column from one aggregation; a constant column gets 1."""
    parts = [f(F.col(c).cast("double")) for c in columns for f in (F.avg, F.stddev_pop)]
    row = df.agg(*parts).first()
    return {c: (row[2 * i] or 0.0, row[2 * i + 1] or 1.0) for i, c in enumerate(columns)}


def scale(df: DataFrame, scaling: Scaling, suffix: str = "") -> DataFrame:
    """Columns keep their name, or get a suffix."""
    return df.withColumns(
        {c + suffix: (F.col(c).cast("double") - F.lit(mean)) / F.lit(sd) for c, (mean, sd) in scaling.items()}
    )


def scaling_stage(scaling: Scaling, suffix: str = "") -> SQLTransformer:
    """The same scaling as a pipeline stage, which is saved and loaded with the model behind it.

    Without a suffix the scaled values replace the columns.
    """
    scaled = [f"(CAST(`{c}` AS DOUBLE) - {mean!r}D) / {sd!r}D AS `{c}{suffix}`" for c, (mean, sd) in scaling.items()]
    rest = "*" if suffix else f"* EXCEPT ({', '.join(f'`{c}`' for c in scaling)})"
    return SQLTransformer(statement=f"SELECT {rest}, {', '.join(scaled)} FROM __THIS__")
