"""Mixing sources to target weights by blocks.

1. Pack: the documents of a source are laid end to end in a seeded order and their words cut into blocks of a fixed
   length (the last block of a source may be shorter).
2. Draw: every source gets a whole number of slots, its target in blocks. The slots are dealt over the places of the
   output shards by a pseudorandom permutation. The counts per shard are then a multivariate hypergeometric draw: multinomial
   draws for each shard, given the totals of the sources. Without that condition a source would miss its target by the root
   of its slots and could exceed the repeat limit. Targets are met to one and a half blocks.
3. Map: the slots of a source run through a pseudorandom permutation of its block numbers, a new one for each pass,
   so each block is taken as often as any other, give or take one.
4. Join the blocks by (source, block number).

DataFrame operations only. Everything random is a hash of the seed: reruns agree, and a lost task repeats itself.

Defined results: a NULL source is a source of its own, sorted last; NULL, empty and blank texts have size 0 and take
nothing; rows that repeat a doc_id, or have none, are packed one by one; a source without words has target 0; an empty
table gives an empty mixture. Other columns don't matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perilscope.llm.ranking import bucket_count, leading_share, running, shuffle_key
from perilscope.llm.text import ROW_KEY, attach, with_row_key, words
from perilscope.session import cut_lineage, shuffle_width

WEIGHTS = (1, 2, 3)
BLOCK_WORDS = 32
SHARD_BLOCKS = 4096
MAX_REPEAT = 3
ROUNDS = 12
SEED = 29
SOURCE = ["_none", "_source"]


@dataclass(frozen=True)
class Mix:
    """The stored parts of a mixture.

    sources: SOURCE, source_size, weight, target, blocks, slots, first_slot; one row per source.
    packed: doc_id, ROW_KEY, SOURCE, size, _start (place of the first word in the stream of the source).
    counts: shard, SOURCE, drawn, first_draw: the source counts per output shard.
    """

    sources: DataFrame
    packed: DataFrame
    counts: DataFrame
    block_words: int
    seed: int


def source_targets(sizes: DataFrame, weights: tuple[int, ...], max_repeat: int) -> DataFrame:
    """Shares of the total size by weight, limited to ``max_repeat`` times the own size, the excess reshared.

    Resharing until nothing is above its limit ends at one level per unit of weight: sources in the order of limit to
    weight stop at their limit until the level that is left fits the next one. The table has one row per source.
    """
    everything = Window.partitionBy(F.lit(0))
    weighted = sizes.withColumn("_i", F.row_number().over(Window.orderBy(*SOURCE)) - 1).withColumn(
        "weight", F.get(F.array(*[F.lit(w) for w in weights]), (F.col("_i") % len(weights)).cast("int"))
    )
    limit = F.col("source_size") * max_repeat
    by_ratio = Window.orderBy(limit / F.col("weight"), *SOURCE)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0))
    shared = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levels = weighted.withColumns({"_level": left / shared, "_order": F.row_number().over(by_ratio)})
    fits = F.when(F.col("_level") * F.col("weight") <= limit, F.struct("_order", "_level"))
    levels = levels.withColumn("_fit", F.min(fits).over(everything)["_level"])
    target = F.least(F.col("_fit") * F.col("weight"), limit.cast("double"))
    return levels.withColumn("target", target).drop("_i", "_level", "_order", "_fit")


def permuted(place: Column, size: Column, *label: Column, rounds: int = ROUNDS) -> Column:
    """A pseudorandom permutation of 0 .. size-1 applied to ``place``: the swap-or-not shuffle.

    In each round a place and its mirror image about a keyed point swap or stay, as a keyed bit of the pair says;
    that is a permutation for any size.
    """

    def swap(at: Column, number: Column) -> Column:
        mirror = F.pmod(F.xxhash64(number, *label) - at, size)
        bit = F.xxhash64(F.greatest(at, mirror), number, *label).bitwiseAND(F.lit(1))
        return F.when(bit == 1, mirror).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), place.cast("bigint"), swap)


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    block_words: int = BLOCK_WORDS,
    shard_blocks: int = SHARD_BLOCKS,
    max_repeat: int = MAX_REPEAT,
    seed: int = SEED,
) -> Mix:
    """Targets, packing and drawn counts; three narrow tables, each stored once in the shared folder."""
    sized = docs.select("doc_id", "source", "text").withColumns(
        {
            "size": F.size(words(F.col("text"))).cast("bigint"),
            "_source": F.coalesce("source", F.lit("")),
            "_none": F.col("source").isNull(),
            "_key": shuffle_key(seed, F.col("doc_id")),
        }
    )
    sized = cut_lineage(with_row_key(sized).drop("text", "source"))
    sizes = cut_lineage(sized.groupBy(*SOURCE).agg(F.sum("size").alias("source_size")))
    blocks = F.ceil(F.col("source_size") / block_words).cast("bigint")
    wanted = F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("bigint")
    slots = F.when(F.col("source_size") > 0, F.least(wanted, F.col("blocks") * max_repeat)).otherwise(F.lit(0))
    ahead = Window.orderBy(*SOURCE).rowsBetween(Window.unboundedPreceding, -1)
    sources = cut_lineage(
        source_targets(sizes, weights, max_repeat)
        .withColumn("blocks", blocks)
        .withColumn("slots", slots.cast("bigint"))
        .withColumn("first_slot", F.coalesce(F.sum("slots").over(ahead), F.lit(0)))
    )
    buckets = bucket_count(sized.count())
    keyed = sized.withColumn("_bucket", F.floor(leading_share(F.col("_key")) * buckets))
    order = ["_key", "size", "_row_hash", "_nth"]
    packed = cut_lineage(running(keyed, SOURCE, "_bucket", order, {"_start": F.col("size")}).drop("_bucket", "_key"))
    return Mix(sources, packed, cut_lineage(draw_counts(sources, shard_blocks, seed)), block_words, seed)


def numbered(df: DataFrame, count: str, out: str, piece: int = 1 << 16) -> DataFrame:
    """A row for each number from 0 below ``count``; made in pieces, so that a large count spreads over tasks."""
    pieces = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(count) - 1) / piece)))
    spread = df.filter(F.col(count) > 0).select("*", pieces.alias("_piece"))
    first = F.col("_piece") * piece
    numbers = F.sequence(first, F.least(first + piece, F.col(count)) - 1)
    # A stated width, as AQE would put the few rows that are still to be multiplied into one task.
    dealt = spread.repartition(shuffle_width(df.sparkSession), *spread.columns)
    return dealt.select("*", F.explode(numbers).alias(out)).drop("_piece")


def draw_counts(sources: DataFrame, shard_blocks: int, seed: int) -> DataFrame:
    """How many blocks of each source go to each output shard, and how many went to earlier shards."""
    total = sources.withColumn("_all", F.sum("slots").over(Window.partitionBy(F.lit(0))))
    slots = numbered(total.select(*SOURCE, "slots", "first_slot", "_all"), "slots", "_slot")
    place = permuted(F.col("first_slot") + F.col("_slot"), F.col("_all"), F.lit(seed), F.lit("place"))
    counts = slots.groupBy(F.floor(place / shard_blocks).alias("shard"), *SOURCE).agg(F.count(F.lit(1)).alias("drawn"))
    before = Window.partitionBy(*SOURCE).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("first_draw", F.coalesce(F.sum("drawn").over(before), F.lit(0)))


def placed_blocks(mixed: Mix) -> DataFrame:
    """shard, SOURCE, block: one row for each block of the output, repeats included."""
    counts = mixed.counts.join(mixed.sources.select(*SOURCE, "blocks"), SOURCE)
    draw = F.col("first_draw") + F.col("_nth")
    turn = F.floor(draw / F.col("blocks"))
    label = (F.lit(mixed.seed), F.lit("block"), *[F.col(c) for c in SOURCE], turn)
    block = permuted(draw % F.col("blocks"), F.col("blocks"), *label)
    return numbered(counts, "drawn", "_nth").select("shard", *SOURCE, block.alias("block"))


def taken_pieces(mixed: Mix) -> DataFrame:
    """Every document cut at the block borders: packed's columns, block, _from (word in it), _words, _times (taken)."""
    length = mixed.block_words
    last = F.floor((F.col("_start") + F.col("size") - 1) / length)
    blocks = F.explode(F.sequence(F.floor(F.col("_start") / length), last))
    cut = mixed.packed.filter(F.col("size") > 0).withColumn("block", blocks)
    start = F.greatest(F.col("block") * length - F.col("_start"), F.lit(0))
    end = F.least((F.col("block") + 1) * length - F.col("_start"), F.col("size"))
    times = placed_blocks(mixed).groupBy(*SOURCE, "block").agg(F.count(F.lit(1)).alias("_times"))
    return cut.withColumns({"_from": start, "_words": end - start}).join(times, [*SOURCE, "block"])


def taken_words(mixed: Mix) -> DataFrame:
    """doc_id, size, source_size, target and taken (words of it in the mixture, repeats counted); one row per document."""
    row = ["doc_id", "size", *SOURCE, *ROW_KEY]
    sums = taken_pieces(mixed).groupBy(*row).agg(F.sum(F.col("_words") * F.col("_times")).alias("taken"))
    found = mixed.packed.select(*row).join(sums.drop("doc_id", "size", *SOURCE), ROW_KEY, "left")
    return found.join(mixed.sources, SOURCE).select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")
    )


def mixed_blocks(docs: DataFrame, mixed: Mix) -> DataFrame:
    """The mixture in blocks: shard, source, block, doc_id, _from and the words, a row per piece of a placed block."""
    piece = F.struct("block", F.slice(words(F.col("text")), F.col("_first"), F.col("_count")).alias("words"))
    cut = taken_pieces(mixed).select(
        *ROW_KEY, "block", (F.col("_from") + 1).cast("int").alias("_first"), F.col("_words").cast("int").alias("_count")
    )
    texts = attach(docs.select("doc_id", "source", "text"), cut).select("_doc.*", "block", "_first", "_count")
    texts = texts.select("doc_id", "source", "_first", piece.alias("_piece"))
    placed = placed_blocks(mixed).withColumn("source", F.when(~F.col("_none"), F.col("_source")))
    texts = texts.select("doc_id", F.col("source").alias("_s"), "_first", "_piece.*")
    joined = placed.join(texts, (placed["source"].eqNullSafe(texts["_s"])) & (placed["block"] == texts["block"]))
    return joined.select("shard", "source", placed["block"], "doc_id", (F.col("_first") - 1).alias("_from"), "words")


def mixed_documents(docs: DataFrame, mixed: Mix) -> DataFrame:
    """The mixture as documents: pass p of a document has the words of its blocks that were taken p times or more.

    A pass that takes every word keeps the text as it was; another joins its words by one space and has n_chars of
    the new text. Columns as in ``docs``; a document appears once per pass, at most ``max_repeat`` times.
    """
    part = F.struct("_from", "_words", "_times")
    parts = taken_pieces(mixed).groupBy(*ROW_KEY).agg(
        F.sort_array(F.collect_list(part)).alias("_parts"), F.max("_times").alias("_most")
    )
    rows = attach(docs, parts).withColumn("_pass", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_most"))))
    chosen = F.filter("_parts", lambda p: p["_times"] >= F.col("_pass"))
    rows = rows.withColumns({"_chosen": chosen, "_text": F.col("_doc.text")}).withColumn("_list", words(F.col("_text")))
    count = F.aggregate("_chosen", F.lit(0).cast("bigint"), lambda total, p: total + p["_words"])
    taken = F.flatten(
        F.transform("_chosen", lambda p: F.slice(F.col("_list"), (p["_from"] + 1).cast("int"), p["_words"].cast("int")))
    )
    text = F.when(count == F.size("_list"), F.col("_text")).otherwise(F.array_join(taken, " "))
    rows = rows.select("_doc", text.alias("_text"))
    made = {"text": F.col("_text"), "n_chars": F.char_length("_text")}
    kinds = {field.name: field.dataType for field in docs.schema.fields}
    return rows.select(
        *[
            made[name].cast(kinds[name]).alias(name) if name in made else F.col("_doc").getField(name).alias(name)
            for name in docs.columns
        ]
    )
