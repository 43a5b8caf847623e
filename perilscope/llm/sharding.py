"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seed inside each source and ranked; the row of rank r among n gets the fractional rank
(r + 1/2) / n. Sorted by it, the sources interleave in proportion. Each source's order is cut where its rows are due: with the
sources in a seeded order and A rows up to and with a source, the first j of k shards hold floor(A j / k) of those rows. A source's
part of that is the difference to the sources before it, off from its own share by less than one row. So

- shard sizes differ by one row at most, as the last A is the total,
- the rows of a source in a shard differ from its share by less than two, however many sources there are.

Inside a shard rows stand by fractional rank.

DataFrame operations only. No window holds a whole source: see ``ranking``. Places are found on narrow rows.

Defined results: a NULL source is a source of its own, sorted last; rows without doc_id are shuffled by checksum
and size; identical rows take neighbouring places, in either order; NULL text has size 1 and the checksum
of no bytes; an empty table gives an empty result. Other columns don't matter; those called like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilscope.llm.ranking import bucket_count, leading_share, running, shuffle_key
from perilscope.llm.text import ROW_KEY, attach, with_row_key
from perilscope.session import cut_lineage

SHARDS = 8
SEED = 17
SOURCE = ["_none", "_source"]
PLACED = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def source_cuts(sizes: DataFrame, shards: int, seed: int) -> DataFrame:
    """The row of each source with ``_cuts``: how many of its rows go to the first 0, 1, ... ``shards`` shards."""
    keyed = sizes.withColumn("_key", shuffle_key(seed, F.when(~F.col("_none"), F.col("_source"))))
    keyed = keyed.withColumns({"_all": F.lit(0), "_bucket": F.floor(leading_share(F.col("_key")) * bucket_count(sizes.count()))})
    ahead = running(keyed, ["_all"], "_bucket", ["_key", *SOURCE], {"_ahead": F.col("_n")})

    def due(rows: Column, j: Column) -> Column:
        """floor(rows * j / shards) without a product beyond a long."""
        return F.floor(rows / shards) * j + F.floor((rows % shards) * j / shards)

    each = F.sequence(F.lit(0), F.lit(shards))
    cuts = F.transform(each, lambda j: due(F.col("_ahead") + F.col("_n"), j) - due(F.col("_ahead"), j))
    return ahead.select(*SOURCE, "_n", cuts.alias("_cuts"))


def interleave(rows: DataFrame, total: int, shards: int, seed: int) -> DataFrame:
    """``rows`` (doc_id, source, size, text_crc32 and more) with law, shard, slot and grown_shard."""
    buckets = bucket_count(total)
    text_number = F.col("text_crc32") * F.lit(1 << 31) + F.col("size")
    rows = rows.withColumns(
        {
            "_source": F.coalesce("source", F.lit("")),
            "_none": F.col("source").isNull(),
            "_key": shuffle_key(seed, F.col("doc_id"), text_number),
        }
    ).withColumn("_bucket", F.floor(leading_share(F.col("_key")) * buckets))
    ranked = running(rows, SOURCE, "_bucket", ["_key", "text_crc32", "size"], {"_rank": F.lit(1).cast("bigint")})
    sizes = cut_lineage(rows.groupBy(*SOURCE).agg(F.count(F.lit(1)).alias("_n")))
    placed = ranked.drop("_bucket").join(source_cuts(sizes, shards, seed), SOURCE)
    passed = F.size(F.filter("_cuts", lambda cut: cut <= F.col("_rank"))) - 1
    placed = placed.withColumns({"shard": passed.cast("int"), "_fraction": (F.col("_rank") + 0.5) / F.col("_n")})
    placed = placed.withColumn("_bucket", F.floor(F.col("_fraction") * buckets))
    placed = running(placed, ["shard"], "_bucket", ["_fraction", *SOURCE], {"slot": F.lit(1).cast("bigint")})
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")}).drop(
        "_source", "_none", "_key", "_bucket", "_rank", "_n", "_cuts", "_fraction"
    )


def measured(docs: DataFrame) -> DataFrame:
    """size: UTF-8 bytes of the text plus 1; text_crc32: its checksum."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns(
        {
            "size": (F.octet_length(text) + 1).cast("bigint"),
            "text_crc32": F.crc32(text.cast("binary")),
        }
    )


def assign(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The manifest: doc_id, size, text_crc32, law ("rows"), shard, slot (gapless from 0 in its shard), grown_shard.

    grown_shard is NULL: under this law another shard count moves rows between old shards.
    """
    rows = measured(docs.select("doc_id", "source", "text")).drop("text")
    return interleave(rows, docs.count(), shards, seed).select("doc_id", *PLACED)


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Every row of ``docs``, all columns, with the columns of the manifest."""
    kept = docs.drop(*PLACED)
    rows = with_row_key(measured(kept.select("doc_id", "source", "text"))).drop("text")
    placed = interleave(rows, docs.count(), shards, seed).select(*ROW_KEY, *PLACED)
    return attach(kept, placed).select("_doc.*", *PLACED)
