"""Stored tables and named views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Schema per layer.
STAGING_SCHEMA = "dbt_staging"
MARTS_SCHEMA = "dbt_marts"


def view_name(model: str, schema: str | None = None, default: str = STAGING_SCHEMA) -> str:
    """A layer's own schema name is used as it is, the default only where none is set."""
    return f"{schema or default}_{model}"


def register_view(df: DataFrame, model: str, schema: str | None = None) -> str:
    name = view_name(model, schema)
    df.createOrReplaceTempView(name)
    return name


def replace_table(df: DataFrame, path: str) -> None:
    """Full refresh of a small or derived table."""
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def store_models(models: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Write each model once and hand back the stored versions, so later steps do not recompute them."""
    stored = {}
    for name, df in models.items():
        replace_table(df, f"{folder}/{name}")
        stored[name] = read_table(df.sparkSession, f"{folder}/{name}")
    return stored
