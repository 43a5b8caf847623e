"""Price index: tab-separated series file to yearly deflators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perilscope.vocab import DEFAULT_CUTOFFS, Cutoffs

# All items, all urban consumers; M13 is the published annual average.
SERIES = "CUUR0000SA0"
ANNUAL = "M13"


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, headers and values trimmed (the file pads both)."""
    raw = spark.read.option("header", True).option("sep", "\t").csv(path)
    named = raw.toDF(*[c.strip() for c in raw.columns])
    return named.select(*[F.trim(F.col(c)).alias(c) for c in named.columns])


def annual_averages(series: DataFrame, cutoffs: Cutoffs = DEFAULT_CUTOFFS) -> DataFrame:
    picked = series.filter((F.col("series_id") == SERIES) & (F.col("period") == ANNUAL)).select(
        F.col("year").cast("bigint").alias("year"), F.col("value").cast("double").alias("cpi_annual_avg")
    )
    return picked.filter(F.col("year") >= cutoffs.min_year)


def with_deflator(averages: DataFrame, cutoffs: Cutoffs = DEFAULT_CUTOFFS) -> DataFrame:
    """Base-year index over each year's index; the job fails when the base year is absent."""
    base = F.max(F.when(F.col("year") == cutoffs.base_year, F.col("cpi_annual_avg")))
    missing = F.raise_error(F.lit(f"no price index for base year {cutoffs.base_year}")).cast("double")
    return averages.select(
        "year",
        "cpi_annual_avg",
        F.lit(cutoffs.base_year).cast("bigint").alias("cpi_base_year"),
        (F.coalesce(averages.agg(base).scalar(), missing) / F.col("cpi_annual_avg")).alias("deflator"),
    )
