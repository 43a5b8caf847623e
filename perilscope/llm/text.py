"""Column expressions on text that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perilscope.session import cut_lineage

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Words of the whole text in order; NULL has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda word: word != "")


def fold_ascii(text: Column) -> Column:
    """A-Z in lower case; no other letter changes."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


BROADCAST_ROWS = 200_000


def broadcast_if_few(df: DataFrame) -> DataFrame:
    """Broadcast a frame of a few plain columns if a count shows that it is small; otherwise Spark picks the join.

    The bound is a few MB; it changes the plan and no row.
    """
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


ROW_KEY = ["_id", "_no_id", "_row_hash", "_nth"]


def with_row_hash(df: DataFrame) -> DataFrame:
    """Add the first three columns of ``ROW_KEY``."""
    return df.withColumns(
        {
            "_id": F.coalesce("doc_id", F.lit(0)).cast("bigint"),
            "_no_id": F.col("doc_id").isNull(),
            "_row_hash": F.xxhash64("source", "text"),
        }
    )


def with_row_key(df: DataFrame) -> DataFrame:
    """Add ``ROW_KEY``: doc_id, a hash of source and text, and a number among rows that agree in all of them.

    It lets decisions be made on narrow rows and joined to the texts afterwards, one shuffle of the text in all, also
    where rows repeat or have no id.
    """
    same = Window.partitionBy("_id", "_no_id", "_row_hash").orderBy("_row_hash")
    return with_row_hash(df).withColumn("_nth", F.row_number().over(same))


def bundled(names: list[str]) -> Column:
    """Some columns, or none, as one: whatever they are called, they clash with nothing."""
    filler = "_" * (1 + max((len(name) for name in names), default=0))
    return F.struct(*[F.col(f"`{name}`") for name in names], F.lit(0).alias(filler))


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, source, text and ``_doc``, the whole row: whatever its columns are called, they clash with nothing."""
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_doc")
    return docs.select("doc_id", "source", "text", row)


def attach(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """``_doc`` and what was decided for that row; ``decided`` has ``ROW_KEY`` and columns of its own."""
    rows = with_row_key(packed(docs)).drop("doc_id", "source", "text")
    joined = rows.join(decided.withColumnRenamed("_nth", "_nth_decided"), ROW_KEY[:3])
    return joined.filter(F.abs(F.col("_nth") - F.col("_nth_decided")) < 1).drop(*ROW_KEY, "_nth_decided")


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows of ``docs``, unchanged, that aren't in ``rejected`` (the first three columns of ``ROW_KEY``)."""
    few = broadcast_if_few(cut_lineage(rejected))
    return with_row_hash(packed(docs)).join(few, ROW_KEY[:3], "left_anti").select("_doc.*")
