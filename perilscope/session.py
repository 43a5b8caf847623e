"""Session settings and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that results depend on. Sizing (memory, executors, shuffle partitions) is left to the cluster.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
}
# The JVM never compiles a method of more than 8,000 bytes; Spark's own limit is 65,535. Wide projections beyond it are left to
# operators whose generated code is split.
SPEED_SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(
    app: str = "perilscope", cores: int | None = None, memory: str = "12g", settings: dict[str, str] | None = None
) -> SparkSession:
    """Local session for tests and the benchmark; a cluster job brings its own."""
    cores = cores or os.cpu_count() or 4
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**RESULT_SETTINGS, **SPEED_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings that change results and the size of compiled methods; everything else stays as the caller configured it."""
    for key, value in {**RESULT_SETTINGS, **SPEED_SETTINGS}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shuffle_width(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), 1)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; only an unset local run gets one of its own."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the frame to the shared folder and read it back.

    The result survives the loss of executors, is read column by column, and its size is known to Catalyst.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
