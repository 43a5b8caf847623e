"""Lookup tables: from CSV files, or the built-in fixed values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perilscope.vocab import STATE_REGIONS, STATES, TYPE_GROUP_ROWS, TYPE_GROUPS


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header; columns are bound by name and cast to the schema."""
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def fixed_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    """A local relation. Unlike a frame built from Python objects its size is known to the optimiser."""

    def literal(value) -> str:
        if value is None:
            return "NULL"
        return "'" + value.replace("'", r"\'") + "'" if isinstance(value, str) else repr(value)

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    frame = spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(f.name for f in schema)})")
    return frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def type_groups(spark: SparkSession) -> DataFrame:
    return fixed_rows(spark, TYPE_GROUP_ROWS, TYPE_GROUPS)


def state_regions(spark: SparkSession) -> DataFrame:
    return fixed_rows(spark, STATES, STATE_REGIONS)
