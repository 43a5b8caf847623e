"""Removal of lines that several documents share.

1. Every text is cut at \\n and exploded. A line's key is the line without white space at both ends, A-Z in lower case; keys of
   at least ``points`` code points take part. From here on a key is 96 bits of hash: rows carry no text.
2. Distinct documents are counted per key with partial sums, so a line that a third of all documents hold costs a row per
   task. Keys of at least ``least`` documents are repeated; the smallest doc_id that holds one is its owner.
3. Lines meet the owner of their key. Keys with a ``HOT_KEYS``-th of all holders or more are ``HOT_KEYS`` at most and are
   broadcast; every other key is too small to burden the task that it is shuffled to.
4. The positions to drop come together per row (a row's own lines, no more) and the text is put together without them.
   The text moves once.

A document is a doc_id. Defined results: rows without doc_id are together one document that owns nothing another document
holds; rows that repeat a doc_id are one document, each judged with all its lines; NULL and empty texts are one empty line
and stay; lines of white space only have no key and stay; an empty table gives an empty result. Other columns go along;
those called like an output are replaced.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from perilscope.llm.text import BLANKS, ROW_KEY, fold_ascii, packed, with_row_hash
from perilscope.session import cut_lineage

KEY_POINTS = 10
LEAST_DOCUMENTS = 2
HOT_KEYS = 10_000
LINE = ["_h", "_g"]
ROW = ROW_KEY[:3]
RESULT = ("n_lines", "n_dropped", "kept_text")


def line_keys(docs: DataFrame, points: int = KEY_POINTS) -> DataFrame:
    """A narrow row per line that takes part: doc_id, the row's key, position, two hashes of the line's key."""
    rows = with_row_hash(docs.select("doc_id", "source", "text"))
    lines = F.split(fold_ascii(F.coalesce("text", F.lit(""))), "\n")
    exploded = rows.select("doc_id", *ROW, F.posexplode(lines).alias("_at", "_line"))
    exploded = exploded.withColumn("_key", F.btrim("_line", F.lit(BLANKS))).filter(F.char_length("_key") >= points)
    return exploded.select("doc_id", *ROW, "_at", F.xxhash64("_key").alias("_h"), F.hash("_key").alias("_g"))


def repeated_keys(lines: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """Keys of at least ``least`` documents: hashes, ``_documents`` and ``_owner``, the smallest doc_id."""
    held = lines.groupBy(*LINE, "doc_id").agg(F.count(F.lit(1)).alias("_times"))
    counted = held.groupBy(*LINE).agg(F.count(F.lit(1)).alias("_documents"), F.min("doc_id").alias("_owner"))
    return counted.filter(F.col("_documents") >= least)


def lines_to_drop(lines: DataFrame, repeated: DataFrame) -> DataFrame:
    """The lines whose key another document owns. Both frames are stored tables."""
    holders = repeated.agg(F.sum("_documents")).first()[0] or 0
    is_hot = F.col("_documents") * HOT_KEYS >= holders
    owners = repeated.select(*LINE, "_owner")
    hot = F.broadcast(owners.filter(is_hot))
    others = lines.join(hot.select(*LINE), LINE, "left_anti").join(owners.filter(~is_hot), LINE)
    met = lines.join(hot, LINE).unionByName(others)
    return met.filter(~F.col("doc_id").eqNullSafe(F.col("_owner")))


@F.pandas_udf(StringType())
def without_lines(texts: pd.Series, positions: pd.Series) -> pd.Series:
    """Each text without the lines at those positions; NULL where there is no text."""

    def left(text: str | None, gone) -> str | None:
        if text is None:
            return None
        drop = set(gone.tolist())
        return "\n".join(line for at, line in enumerate(text.split("\n")) if at not in drop)

    return pd.Series([left(text, gone) for text, gone in zip(texts, positions)], dtype=object)


def remove_repeated_lines(docs: DataFrame, points: int = KEY_POINTS, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """Every row of ``docs``, all columns, with n_lines (before), n_dropped and kept_text (never NULL)."""
    lines = cut_lineage(line_keys(docs, points))
    repeated = cut_lineage(repeated_keys(lines, least))
    dropped = lines_to_drop(lines, repeated).groupBy(*ROW).agg(F.collect_set("_at").alias("_gone"))
    rows = with_row_hash(packed(docs.drop(*RESULT))).drop("doc_id", "source").join(dropped, ROW, "left")
    text = F.coalesce("text", F.lit(""))
    touched = F.col("_gone").isNotNull()
    shorter = without_lines(F.when(touched, text), F.col("_gone"))  # other texts don't go to Python
    return rows.select(
        "_doc.*",
        F.size(F.split(text, "\n")).cast("bigint").alias("n_lines"),
        F.when(touched, F.size("_gone")).otherwise(0).cast("bigint").alias("n_dropped"),
        F.coalesce(shorter, text).alias("kept_text"),
    )
