"""Event files: listing, version choice, load planning, reading and the partitioned raw table."""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from perilscope.session import cut_lineage
from perilscope.vocab import DEFAULT_CUTOFFS, RAW_EVENTS

# File naming.
DETAILS_GLOB = "*StormEvents_details*.csv.gz"
YEAR_PATTERN = r"_d(\d{4})_"

CLUSTER_BY = ("STATE", "EVENT_TYPE")
ENCODING = "ISO-8859-1"


def file_year(name):
    """Year in a file name, NULL when there is none."""
    return F.regexp_extract(name, YEAR_PATTERN, 1).try_cast("bigint")


def list_files(spark: SparkSession, *folders: str, glob: str = DETAILS_GLOB) -> DataFrame:
    """(path, file_name, year, bytes, location) of the detail files; only names are read, not contents.

    location: the path as Spark's readers give it in ``_metadata``.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(list(folders))
    name = F.element_at(F.split("path", "/"), -1)
    return listed.select(
        "path", name.alias("file_name"), file_year(name).alias("year"), F.col("length").alias("bytes"), F.col("_metadata.file_path").alias("location")
    )


def latest_versions(files: DataFrame) -> DataFrame:
    """One file per year: the last name in alphabetical order."""
    newest = files.filter(F.col("year").isNotNull()).groupBy("year")
    picked = newest.agg(F.max(F.struct("file_name", "path", "bytes")).alias("_f"))
    return picked.select("year", "_f.file_name", "_f.path", "_f.bytes")


def plan_years(
    available: DataFrame, loaded: DataFrame, current_year: int, min_year: int = DEFAULT_CUTOFFS.min_year
) -> DataFrame:
    """Years to load: available years not loaded yet, and always the current one."""
    eligible = available.select("year").filter(F.col("year") >= min_year)
    missing = eligible.join(loaded.select("year"), "year", "left_anti")
    current = available.sparkSession.range(1).select(F.lit(current_year).cast("bigint").alias("year"))
    return missing.unionByName(current).distinct()


def conform(df: DataFrame, schema: T.StructType = RAW_EVENTS) -> DataFrame:
    """Bind columns by name: extra ones are dropped, absent ones become NULL, unreadable integers NULL."""
    present = {c for c in df.columns}
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def _first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of a task's first file; the rest of the task's input isn't read."""
    for batch in batches:
        if len(batch):
            yield batch.slice(0, 1)
            return


def read_headers(spark: SparkSession, files: Sequence[tuple[str, str]]) -> dict[str, str]:
    """The first line by path, of (path, location) pairs; empty files have none.

    One job that opens each file and stops at its first batch of lines. A task gives the header of its first file; where Spark put
    several files in a task, the next job reads what is left.
    """
    found: dict[str, str] = {}
    open_ = dict((location, path) for path, location in files)
    while open_:
        lines = spark.read.option("encoding", ENCODING).text(list(open_.values()))
        starts = lines.select("value", F.col("_metadata.file_path").alias("location"), F.col("_metadata.file_block_start").alias("at"))
        rows = starts.filter("at = 0").select("value", "location").mapInArrow(_first_line, "value string, location string").collect()
        if not rows:  # a row per task at most
            break
        found |= {open_.pop(row["location"]): row["value"] for row in rows if row["location"] in open_}
    return found


def header_columns(line: str) -> list[str]:
    """Column names of a header; a name that comes again gets its position."""
    names = next(csv.reader([line.strip("\ufeff\r\n")]))
    return [name if name not in names[:k] else f"{name}_{k}" for k, name in enumerate(names)]


def read_events(spark: SparkSession, *paths: str, glob: str = DETAILS_GLOB, store: bool = False) -> DataFrame:
    """Gzip CSV, latin-1, quoted newlines, everything as text and then bound to the raw schema.

    CSV columns have no names beyond their own file, so files are grouped by header and each header is one scan of all its files
    with a known schema. A gzip file is one task, so rows are spread again when the table is written. ``store`` keeps the texts of
    the raw columns as a table: who reads the rows more than once parses each file only once.
    """
    files = [(row["path"], row["location"]) for row in list_files(spark, *paths, glob=glob).select("path", "location").collect()]
    groups = defaultdict(list)
    for path, line in read_headers(spark, files).items():
        groups[line].append(path)
    union = spark.createDataFrame([], RAW_EVENTS)
    for number, line in enumerate(sorted(groups)):
        schema = T.StructType([T.StructField(name, T.StringType()) for name in header_columns(line)])
        texts = (
            spark.read.schema(schema)
            .option("header", True)
            .option("encoding", ENCODING)
            .option("multiLine", True)
            .option("quote", '"')
            .option("escape", '"')
            .csv(sorted(groups[line]))
        )
        wanted = [name for name in texts.columns if name in RAW_EVENTS.fieldNames()]
        frame = conform(cut_lineage(texts.select(*wanted)) if store and wanted else texts)
        union = union.unionByName(frame) if number else frame
    return union


def loaded_years(spark: SparkSession, table: str) -> DataFrame:
    """Years present in the raw table; none when it does not exist yet. Other errors are raised."""
    try:
        return spark.read.parquet(table).select(F.col("YEAR").cast("bigint").alias("year")).distinct()
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], "year bigint")


def write_years(events: DataFrame, table: str) -> None:
    """Replace exactly the years present in ``events``; other years keep their files.

    New files are staged and swapped in at commit, so a failed job leaves the old year in place and a repeated
    job changes nothing. Rows are dealt to writers by ranges of (year, state, type, event): a year gets as many writers
    as its share of the rows, and each writer has few states.
    """
    order = ("YEAR", *CLUSTER_BY)
    (
        events.repartitionByRange(*order, F.xxhash64("EVENT_ID", "EPISODE_ID"))
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("YEAR")
        .parquet(table)
    )


MANIFEST = T.StructType(
    [
        T.StructField("year", T.LongType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("event_ids", T.LongType()),
        T.StructField("checksum", T.LongType()),
    ]
)


def manifest_of(table: str) -> str:
    """Where the manifest of a raw table lies: a row per loaded year."""
    return f"{table.rstrip('/')}_loads"


def read_manifest(spark: SparkSession, table: str) -> DataFrame:
    """(year, file_name, bytes, rows, event_ids, checksum) of the years that were loaded to the end; none for a new table."""
    try:
        return spark.read.schema(MANIFEST).parquet(manifest_of(table))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def year_sums(table: DataFrame) -> DataFrame:
    """(year, rows, event_ids, checksum): distinct EVENT_IDs; the checksum doesn't depend on the order of rows or files."""
    year = F.col("YEAR").cast("bigint").alias("year")
    row = F.xxhash64(*[F.col(f"`{name}`") for name in sorted(table.columns) if name != "YEAR"])
    by_event = table.select(year, "EVENT_ID", row.alias("h")).groupBy("year", "EVENT_ID").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("h"))
    return by_event.groupBy("year").agg(F.sum("n").alias("rows"), F.count("EVENT_ID").alias("event_ids"), F.bit_xor("h").alias("checksum"))


def write_manifest(chosen: DataFrame, table: str) -> None:
    """Replace the manifest rows of the years in ``chosen`` (year, file_name, bytes), after these years were written.

    A year without a manifest row counts as not loaded: a job that fails between the two writes loads it again.
    """
    spark = chosen.sparkSession
    years = [row["year"] for row in chosen.select("year").collect()]
    stored = spark.read.parquet(table).filter(F.col("YEAR").isin(years))
    entries = chosen.join(year_sums(stored), "year", "left").fillna(0, ["rows", "event_ids"])
    entries.select(*MANIFEST.fieldNames()).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(
        manifest_of(table)
    )


def damaged_years(spark: SparkSession, table: str) -> DataFrame:
    """Loaded years whose stored rows no longer add up to the manifest: year, rows expected and found."""
    found = year_sums(spark.read.parquet(table)).drop("event_ids").withColumnsRenamed({"rows": "found", "checksum": "sum"})
    joined = read_manifest(spark, table).join(found, "year", "left")
    same = (F.col("rows") == F.coalesce("found", F.lit(0))) & F.col("checksum").eqNullSafe(F.col("sum"))
    return joined.filter(~same).select("year", "rows", F.coalesce("found", F.lit(0)).alias("found"))


def years_with_repeats(spark: SparkSession, table: str) -> DataFrame:
    """Years in which an event id repeats or is missing: year, rows and event_ids.

    An event is known by its id and year, so the counts that were taken when a year was loaded settle it: only the manifest is read, and a
    new year never makes the check read the old ones again.
    """
    return read_manifest(spark, table).filter(F.col("rows") != F.col("event_ids")).select("year", "rows", "event_ids")


def load_events(
    spark: SparkSession,
    folder: str,
    table: str,
    current_year: int,
    year: int | None = None,
    min_year: int = DEFAULT_CUTOFFS.min_year,
    reload_changed: bool = False,
) -> list[int]:
    """List, choose versions, plan, read and replace the planned years, then note them in the manifest. Returns the years written.

    Loaded are the years that the manifest and the table both have. ``reload_changed`` also loads the years whose file is not the one
    in the manifest any more. The file list (one row per year) is the only thing the driver sees.
    """
    files = latest_versions(list_files(spark, folder))
    if year is None:
        manifest = read_manifest(spark, table)
        done = manifest.join(loaded_years(spark, table), "year", "left_semi")
        if reload_changed:
            done = done.join(files.select("year", "file_name", "bytes"), ["year", "file_name", "bytes"], "left_semi")
        wanted = plan_years(files, done, current_year, min_year)
    else:
        wanted = files.select("year").filter(F.col("year") == year)
    chosen = cut_lineage(files.join(wanted, "year", "left_semi"))
    listed = [(row["year"], row["path"]) for row in chosen.orderBy("year").collect()]
    if listed:
        write_years(read_events(spark, *[path for _, path in listed], store=True), table)  # dealing by ranges samples the rows first
        write_manifest(chosen.select("year", "file_name", "bytes"), table)
    return [y for y, _ in listed]
