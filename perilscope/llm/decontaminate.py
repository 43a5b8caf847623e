"""Benchmark decontamination: short test items inside long documents.

An item counts as contained in a document when at least ``CONTAINMENT`` of its distinct word shingles are among the
shingles of the document. One hash orders all shingles. Items are partitioned by size (distinct shingles); the sketch of
an item is its k smallest hashes, with k = size - ceil(containment x size) + 1 for its partition. A document that lacks
all k lacks too many shingles, so looking up document shingles among the sketches loses no contained item, however
long the document is; documents too short for a partition are left out of it. Each found pair is then verified on the
full shingle sets.

DataFrame operations only. The sketch index and the item sets are broadcast only while they are small (a counted
bound); beyond it the same joins shuffle. Per document and item one row is aggregated.

Defined results: texts are compared by words with A-Z in lower case; an item with fewer words than a shingle is one
shingle of all its words, found only in a document with just these words; items or documents without words or text
match nothing; rows with the same item_id are one item with the union of their shingles, and likewise for doc_id in ``contained``;
``clean`` decides row by row. NULL ids match nothing in ``contained``; ``clean`` still drops such a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilscope.llm.text import ROW_KEY, broadcast_if_few, fold_ascii, with_row_hash, without, words
from perilscope.session import cut_lineage

SHINGLE = 5
CONTAINMENT = 0.8


def with_shingles(df: DataFrame, words_each: int = SHINGLE) -> DataFrame:
    """Add ``_shingles``: distinct 64-bit hashes of the word shingles.

    Explode it with ``explode_outer``: for ``explode`` Catalyst infers a size filter, pushes it below the projection and
    would split the text again for every word.
    """
    hashed = df.withColumn("_w", F.transform(words(fold_ascii(F.col("text"))), lambda word: F.xxhash64(word)))
    starts = F.sequence(F.lit(0), F.size("_w") - words_each)
    runs = F.transform(starts, lambda i: F.xxhash64(*[F.get("_w", i + k) for k in range(words_each)]))
    few = F.when(F.size("_w") > 0, F.array(F.xxhash64("_w"))).otherwise(F.array().cast("array<bigint>"))
    return hashed.withColumn("_shingles", F.array_distinct(F.when(F.size("_w") >= words_each, runs).otherwise(few))).drop("_w")


def item_index(items: DataFrame, words_each: int = SHINGLE, containment: float = CONTAINMENT) -> DataFrame:
    """item_id, shingle, size, need (shingles that make it contained), sketched (among the item's k smallest hashes)."""
    exploded = with_shingles(items.select("item_id", "text").filter(F.col("item_id").isNotNull()), words_each)
    sets = exploded.select("item_id", F.explode_outer("_shingles").alias("_s")).groupBy("item_id").agg(
        F.array_sort(F.collect_set("_s")).alias("_set")
    )
    sized = sets.withColumn("size", F.size("_set")).withColumn("need", needed(F.col("size"), containment))
    entries = sized.select("item_id", "size", "need", F.posexplode("_set").alias("_place", "shingle"))
    return entries.withColumn("sketched", F.col("_place") <= F.col("size") - F.col("need")).drop("_place")


def needed(size: Column, containment: float) -> Column:
    """The least number of shared shingles, in whole thousandths to stay clear of rounding."""
    return F.ceil(size * F.lit(round(containment * 1000)) / 1000).cast("int")


def sketch_hits(docs: DataFrame, index: DataFrame, keys: list[str], words_each: int = SHINGLE) -> DataFrame:
    """keys, item_id, size: distinct pairs where a sketch value of the item is among the document's shingles."""
    sketches = index.filter("sketched").select("item_id", "size", "need", "shingle")
    rows = with_shingles(docs, words_each).select(*keys, F.size("_shingles").alias("_n"), F.explode_outer("_shingles").alias("shingle"))
    found = rows.join(broadcast_if_few(sketches), "shingle").filter(F.col("_n") >= F.col("need"))
    return found.select(*keys, "item_id").distinct()


def verified(docs: DataFrame, hits: DataFrame, index: DataFrame, keys: list[str], words_each: int = SHINGLE) -> DataFrame:
    """keys, item_id, n_shared, n_item: pairs whose shared shingles reach the containment, from the full sets."""
    texts = docs.join(broadcast_if_few(hits.select(*keys).distinct()), keys, "left_semi")
    rows = with_shingles(texts, words_each).select(*keys, F.explode_outer("_shingles").alias("shingle"))
    entries = index.select("item_id", "shingle", "size", "need")
    shared = rows.join(broadcast_if_few(entries), "shingle").groupBy(*keys, "item_id").agg(
        F.count_distinct("shingle").alias("n_shared"), F.max("size").alias("n_item"), F.max("need").alias("_need")
    )
    confirmed = shared.filter(F.col("n_shared") >= F.col("_need")).drop("_need")
    return confirmed.join(hits, [*keys, "item_id"], "left_semi")


def contained(
    docs: DataFrame, items: DataFrame, words_each: int = SHINGLE, containment: float = CONTAINMENT
) -> DataFrame:
    """doc_id, item_id, n_shared, n_item, containment: every document and every item that it contains."""
    index = cut_lineage(item_index(items, words_each, containment))
    texts = docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull())
    hits = cut_lineage(sketch_hits(texts, index, ["doc_id"], words_each))
    pairs = verified(texts, hits, index, ["doc_id"], words_each)
    return pairs.select(
        "doc_id",
        "item_id",
        F.col("n_shared").cast("bigint").alias("n_shared"),
        F.col("n_item").cast("bigint").alias("n_item"),
        (F.col("n_shared") / F.col("n_item")).alias("containment"),
    )


def clean(docs: DataFrame, items: DataFrame, words_each: int = SHINGLE, containment: float = CONTAINMENT) -> DataFrame:
    """The documents that contain no item, unchanged."""
    keys = ROW_KEY[:3]
    index = cut_lineage(item_index(items, words_each, containment))
    texts = with_row_hash(docs.select("doc_id", "source", "text")).select(*keys, "text")
    hits = cut_lineage(sketch_hits(texts, index, keys, words_each))
    dirty = verified(texts, hits, index, keys, words_each).select(*keys).distinct()
    return without(docs, dirty)
