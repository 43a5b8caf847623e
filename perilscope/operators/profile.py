"""Column profiles: counts, rates, moments, quantiles, histograms, correlations."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilscope.functions.scalars import safe_ratio
from perilscope.operators.prefix import exact_quantiles
from perilscope.sources.seeds import fixed_rows
from perilscope.vocab import TEXT, WHOLE, columns


def rate_by(df: DataFrame, keys: Sequence[str], flag: Column) -> DataFrame:
    """Rows, flagged rows and percentage flagged per category."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), F.sum(flag.cast("bigint")).alias("flagged"))
    return counts.withColumn("rate_pct", F.round(safe_ratio(F.col("flagged"), F.col("total")) * 100, 6))


def mean_by(df: DataFrame, key: str, value: Column, out: str) -> DataFrame:
    """Target rate per category: exact integer sum over count."""
    return df.groupBy(key).agg(safe_ratio(F.sum(value.cast("bigint")), F.count(F.lit(1))).alias(out))


def value_counts(df: DataFrame, column: str, order: Sequence[str] | None = None) -> DataFrame:
    """Count and share per value; with ``order`` absent categories appear with 0, others are left out."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    if order is not None:
        known = fixed_rows(
            df.sparkSession, [(v, i) for i, v in enumerate(order)], columns(**{column: TEXT, "position": WHOLE})
        )
        counts = known.join(counts, column, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return counts.withColumn("share", F.round(safe_ratio(F.col("n"), total), 6))


def moments(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """count, mean, sample standard deviation, minimum and maximum of every column in one pass, long form."""
    parts = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("count"),
            F.avg(F.col(c).cast("double")).alias("mean"),
            F.stddev_samp(F.col(c).cast("double")).alias("std"),
            F.min(F.col(c).cast("double")).alias("min"),
            F.max(F.col(c).cast("double")).alias("max"),
        )
        for c in names
    ]
    return df.agg(F.array(*parts).alias("_c")).select(F.inline("_c"))


def describe(df: DataFrame, names: Sequence[str], digits: int = 4) -> DataFrame:
    """Moments plus exact quartiles, one row per column."""
    quartiles = exact_quantiles(df, names, [0.25, 0.5, 0.75])
    table = moments(df, names).join(quartiles, "column_name", "left")

    def shown(name: str) -> Column:
        return F.round(F.col(name), digits)

    return table.select(
        "column_name",
        "count",
        shown("mean").alias("mean"),
        shown("std").alias("std"),
        shown("min").alias("min"),
        shown("p0").alias("q25"),
        shown("p1").alias("q50"),
        shown("p2").alias("q75"),
        shown("max").alias("max"),
    )


def missing_rates(df: DataFrame, names: Sequence[str]) -> DataFrame:
    shares = df.agg(*[safe_ratio(F.count_if(F.col(c).isNull()), F.count(F.lit(1))).alias(c) for c in names])
    long = shares.unpivot([], list(names), "column_name", "missing_rate")
    return long.withColumn("missing_rate", F.round("missing_rate", 6))


def corrected_skewness(value: Column) -> Column:
    """Adjusted Fisher-Pearson coefficient; Spark's own is the population form."""
    n = F.count(value).cast("double")
    return F.when(n > 2, F.skewness(value) * F.sqrt(n * (n - 1)) / (n - 2))


def skewness_raw_and_log(df: DataFrame, names: Sequence[str], digits: int = 6) -> DataFrame:
    """Skewness of all values, and of log(1 + x) over the positive ones."""
    parts = []
    for c in names:
        value = F.col(c).cast("double")
        parts.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.round(corrected_skewness(value), digits).alias("skewness"),
                F.round(corrected_skewness(F.when(value > 0, F.log1p(value))), digits).alias("log_skewness"),
            )
        )
    return df.agg(F.array(*parts).alias("_c")).select(F.inline("_c"))


def correlations(df: DataFrame, features: dict[str, Column], digits: int = 6) -> DataFrame:
    """Pearson correlation of every feature pair in one aggregation, long form, both orders."""
    shaped = df.select(*[value.cast("double").alias(name) for name, value in features.items()])
    parts = []
    for a, b in combinations_with_replacement(features, 2):
        r = F.round(F.corr(a, b), digits)
        parts.append(F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), r.alias("r")))
    upper = shaped.agg(F.array(*parts).alias("_c")).select(F.inline("_c"))
    lower = upper.filter(F.col("feature_a") != F.col("feature_b"))
    lower = lower.select(F.col("feature_b").alias("feature_a"), F.col("feature_a").alias("feature_b"), "r")
    return upper.unionByName(lower)


def histogram(df: DataFrame, value: Column, bins: int = 50) -> DataFrame:
    """Equal-width bins 1..bins between minimum and maximum; the maximum belongs to the last bin."""
    x = df.select(value.cast("double").alias("x")).filter(F.col("x").isNotNull())
    ends = x.agg(F.struct(F.min("x").alias("low"), F.max("x").alias("high"))).scalar()
    low, high = ends["low"], ends["high"]
    place = F.floor((F.col("x") - low) / ((high - low) / F.lit(float(bins)))) + 1
    bin_id = F.when(low == high, F.lit(1)).otherwise(F.least(place, F.lit(bins))).cast("int")
    return x.groupBy(bin_id.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def class_balance(df: DataFrame, split: Column, label: Column) -> DataFrame:
    counts = df.groupBy(split.alias("split"), label.alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return counts
