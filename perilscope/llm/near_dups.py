"""Near duplicates by bottom-k MinHash sketches from one hash function.

1. A text becomes the set of hashes of its word shingles; the ``k`` smallest are its sketch. Texts with equal sets form
   one class, and one representative stands for it from here on.
2. Inverted lists hold the ``index`` smallest values of each sketch. Two sets of similarity t share at least ``need`` of
   them but for a chance below ``MISS``, so it is enough to list each set under its ``index - need + 1`` rarest values:
   values that are common in the corpus make no lists.
3. A list never yields all its pairs. Its members are first linked to a pivot, the member with the most widespread
   sketch; what is confirmed becomes components. Lists that still hold several components are looked at again with
   full sets, by pivots once more, and then only members of different components are paired.
4. The union sketch estimates the similarity of a pair and drops clear misses.
5. What is left is confirmed by the exact Jaccard similarity of the full sets. Components of the confirmed links, with
   the members of the classes, are the groups.

Sketching runs on Arrow batches; all else is DataFrame operations. Intermediate tables are stored in the shared folder.

Defined results: texts are compared by words with A-Z in lower case; a text with fewer words than a shingle is one
shingle of all its words; without words or text the set is empty and linked with nothing. Rows with one doc_id are one
document, linked if any of its texts is. A row without doc_id has component_id NULL, is kept and linked with nothing.
An empty table gives an empty result. Other columns don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perilscope.llm.graph import components
from perilscope.llm.text import ROW_KEY, broadcast_if_few, packed, with_row_hash
from perilscope.llm.wordhash import mixed, slices
from perilscope.session import cut_lineage

SKETCH = 64
INDEX = 24
MISS = 1e-7


def least_shared(size: int, similarity: Fraction, miss: float = MISS) -> int:
    """How many of the ``size`` smallest values of a union are shared, but for a chance below ``miss``.

    The smallest values of the union are a random sample of it, each shared with a chance of ``similarity`` at least;
    drawing without replacement only narrows the binomial bound used here.
    """
    p, tail, shared = float(similarity), 0.0, 0
    while shared < size:
        tail += math.comb(size, shared) * p**shared * (1 - p) ** (size - shared)
        if tail > miss:
            break
        shared += 1
    return max(shared, 1)


def shingle_sets(batches: Iterator[pa.RecordBatch], words_each: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """For each batch the sorted distinct shingle hashes of every text in its column ``text``."""
    for batch in batches:
        found: list[np.ndarray] = []
        for part in slices(batch.column(batch.schema.get_field_index("text")), fold=True):
            runs = part.runs(words_each).view(np.int64)
            for a, b in zip(part.bounds[:-1].tolist(), part.bounds[1:].tolist()):
                if b - a >= words_each:
                    found.append(np.unique(runs[a : b - words_each + 1]))
                elif b > a:
                    whole = mixed(part.spans(np.array([a]), b - a), b - a + 1)
                    found.append(whole.view(np.int64))
                else:
                    found.append(np.zeros(0, dtype=np.int64))
        yield batch, found


def as_lists(sets: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(sets) + 1, dtype=np.int32)
    np.cumsum([len(s) for s in sets], out=offsets[1:])
    values = np.concatenate(sets) if sets else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=pa.int64()))


def sketches(docs: DataFrame, words_each: int, k: int = SKETCH) -> DataFrame:
    """doc_id, n_shingles, f1, f2 (fingerprints of the whole set), sketch (its k smallest hashes)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in shingle_sets(batches, words_each):
            prints = [
                np.array([mixed(s.view(np.uint64), salt).sum(dtype=np.uint64) for s in sets], dtype=np.uint64).view(np.int64)
                for salt in (2, 3)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], type=pa.int64()),
                    pa.array(prints[0], type=pa.int64()),
                    pa.array(prints[1], type=pa.int64()),
                    as_lists([s[:k] for s in sets]),
                ],
                names=["doc_id", "n_shingles", "f1", "f2", "sketch"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(work, "doc_id bigint, n_shingles bigint, f1 bigint, f2 bigint, sketch array<bigint>")


def full_sets(docs: DataFrame, words_each: int) -> DataFrame:
    """doc_id, shingles: the whole set of each row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in shingle_sets(batches, words_each):
            yield pa.RecordBatch.from_arrays([batch.column(0), as_lists(sets)], names=["doc_id", "shingles"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(work, "doc_id bigint, shingles array<bigint>")


def inverted_lists(heads: DataFrame, index: int, need: int, similarity: Fraction) -> DataFrame:
    """value, doc_id, n_shingles, spread: every set under the rarest of its ``index`` smallest values.

    Sets that are complete in the index, with every partner, use the exact bound for sets. Values seen once match
    nothing; they still count as the rarest of their set. spread: how widespread the listed values of the set are.
    """
    entries = heads.select(
        "doc_id", "n_shingles", F.size("top").alias("held"), F.explode("top").alias("value")
    )
    often = entries.groupBy("value").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    shared = entries.join(often, "value")
    complete = F.col("n_shingles") <= math.floor(index * similarity)
    exact = F.col("held") - F.ceil(F.col("held") * float(similarity) - 1e-9)
    sampled = F.col("held") - F.ceil(F.col("held") * (need / index) - 1e-9)
    listed = F.when(complete, exact).otherwise(sampled) + 1
    mine = Window.partitionBy("doc_id", "n_shingles")
    ranked = shared.withColumns(
        {
            "seen": F.count(F.lit(1)).over(mine),
            "rank": F.row_number().over(mine.orderBy("df", "value")),
            "spread": F.sum(weight(F.col("df"))).over(mine),
        }
    )
    chosen = ranked.filter(F.col("rank") + F.col("held") - F.col("seen") <= listed)
    return chosen.select("value", "doc_id", "n_shingles", "spread")


def weight(df: Column) -> Column:
    """Sixteenths of the binary logarithm, as whole numbers: their sums are the same in any order."""
    return F.floor(F.log2(df) * 16)


def near_sizes(a: Column, b: Column, similarity: Fraction) -> Column:
    t, whole = similarity.numerator, similarity.denominator
    return (F.least(a, b) * whole >= F.greatest(a, b) * t)


def reaches(shared: Column, union: Column, similarity: Fraction) -> Column:
    return shared * similarity.denominator >= union * similarity.numerator


def plausible(left: Column, right: Column, k: int, least: int) -> Column:
    """Whether the union sketch of two sketches shares enough values to be worth an exact look."""
    union = F.slice(F.array_sort(F.array_union(left, right)), 1, k)
    common = F.size(F.array_intersect(F.array_intersect(left, right), union))
    return common * k >= F.size(union) * least


def pivot_pairs(lists: DataFrame, similarity: Fraction) -> DataFrame:
    """a, b: members of a list (value, doc_id, n_shingles, spread, label) with its pivot, where their labels differ.

    The pivot is the member with the most widespread values: in a group around a common original that is the original
    or close to it. It comes from a grouped maximum, so a long list is never gathered.
    """
    best = F.max_by(F.struct("doc_id", "n_shingles", "label"), F.struct("spread", -F.col("doc_id"))).alias("pivot")
    pivots = lists.groupBy("value").agg(best)
    paired = lists.join(pivots, "value").filter(F.col("label") != F.col("pivot.label"))
    near = paired.filter(near_sizes(F.col("n_shingles"), F.col("pivot.n_shingles"), similarity))
    return ordered_pairs(near, F.col("doc_id"), F.col("pivot.doc_id"))


def ordered_pairs(df: DataFrame, left: Column, right: Column) -> DataFrame:
    return df.select(F.least(left, right).alias("a"), F.greatest(left, right).alias("b")).distinct()


def only(table: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of these doc_ids; few ids are broadcast, which spares the shuffle of the table."""
    return table.join(broadcast_if_few(ids.distinct()), "doc_id", "left_semi")


def both_sides(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """pairs with ``column`` of a and of b as xa and xb."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b"))
    side = only(table.select("doc_id", column), ids)
    return pairs.join(side.toDF("a", "xa"), "a").join(side.toDF("b", "xb"), "b")


def confirmed(pairs: DataFrame, heads: DataFrame, sets: DataFrame, similarity: Fraction) -> DataFrame:
    """The pairs whose full sets are similar, after the estimate from their sketches. ``pairs`` is a stored table."""
    least = least_shared(SKETCH, similarity)
    likely = both_sides(pairs, heads, "sketch").filter(plausible(F.col("xa"), F.col("xb"), SKETCH, least))
    both = both_sides(cut_lineage(likely.select("a", "b").distinct()), sets, "shingles")
    shared = F.size(F.array_intersect("xa", "xb"))
    similar = reaches(shared, F.size("xa") + F.size("xb") - shared, similarity)
    return cut_lineage(both.filter(similar).select("a", "b").distinct())


def labelled(lists: DataFrame, links: DataFrame) -> DataFrame:
    """The lists that still hold several components, with each member's component in ``label``."""
    groups = components(links)
    named = lists.drop("label").join(groups, lists["doc_id"] == groups["node"], "left")
    named = named.withColumn("label", F.coalesce("component", "doc_id")).drop("node", "component")
    several = named.groupBy("value").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi")
    return cut_lineage(named.join(several.select("value"), "value", "left_semi"))


def exact_lists(lists: DataFrame, sets: DataFrame, similarity: Fraction) -> DataFrame:
    """value, doc_id, n_shingles, place, spread, label: the members of ``lists`` under the rarest shingles of their full sets.

    As many as a similar set must meet one of; ``place`` counts in the order of rarity. Shingles that only one of these sets has
    come first and are left out, as they meet nothing.
    """
    label = lists.select("doc_id", "label").distinct()
    members = only(sets, label.select("doc_id"))
    entries = members.select("doc_id", F.size("shingles").cast("bigint").alias("n_shingles"), F.explode_outer("shingles").alias("value"))
    often = entries.groupBy("value").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    mine = Window.partitionBy("doc_id", "n_shingles")
    met = entries.join(often, "value").withColumns(
        {
            "rank": F.row_number().over(mine.orderBy("df", "value")),
            "met": F.count(F.lit(1)).over(mine),
            "spread": F.sum(weight(F.col("df"))).over(mine),
        }
    )
    met = met.withColumn("place", F.col("n_shingles") - F.col("met") + F.col("rank"))
    t, whole = similarity.numerator, similarity.denominator
    first = met.filter((F.col("n_shingles") - F.col("place") + 1) * whole >= F.col("n_shingles") * t)
    return first.select("value", "doc_id", "n_shingles", "place", "spread").join(label, "doc_id")


def cross_pairs(lists: DataFrame, similarity: Fraction) -> DataFrame:
    """a, b: members of one exact list with different labels that sizes and places don't rule out.

    Where two sets first meet, at places i and j of their orders, they share at most the rest of each; that and the sizes
    are tested inside the join. One side of the join leaves out the most common label of each list, so a large
    component is never paired with itself.
    """
    counts = lists.groupBy("value", "label").agg(F.count(F.lit(1)).alias("count"))
    common = counts.groupBy("value").agg(F.max_by("label", F.struct("count", "label")).alias("common"))
    others = lists.join(common, "value").filter("label <> common").drop("common")
    left, right = lists.alias("l"), others.alias("r")
    n, m = F.col("l.n_shingles"), F.col("r.n_shingles")
    rest = F.least(n - F.col("l.place"), m - F.col("r.place")) + 1
    test = (
        (F.col("l.value") == F.col("r.value"))
        & (F.col("l.label") != F.col("r.label"))
        & near_sizes(n, m, similarity)
        & reaches(rest, n + m - rest, similarity)
    )
    return ordered_pairs(left.join(right, test), F.col("l.doc_id"), F.col("r.doc_id"))


def links_between(heads: DataFrame, docs: DataFrame, words_each: int, similarity: Fraction, index: int) -> DataFrame:
    """a, b: enough exact links between representatives to connect every two that the similarity connects."""
    need = least_shared(index, similarity)
    tops = heads.filter("n_shingles > 0").select("doc_id", "n_shingles", F.slice("sketch", 1, index).alias("top"))
    lists = cut_lineage(inverted_lists(tops, index, need, similarity).withColumn("label", F.col("doc_id")))
    sets = cut_lineage(full_sets(only(docs, lists.select("doc_id")), words_each))
    found = confirmed(cut_lineage(pivot_pairs(lists, similarity)), heads, sets, similarity)
    # What the pivots of the sketches left open: the same with the pivots of full sets, then pairs of what is left.
    exact = cut_lineage(exact_lists(labelled(lists, found), sets, similarity))
    found = found.union(confirmed(cut_lineage(pivot_pairs(exact, similarity)), heads, sets, similarity))
    exact = labelled(exact, found)
    return found.union(confirmed(cut_lineage(cross_pairs(exact, similarity)), heads, sets, similarity))


def near_duplicates(
    docs: DataFrame, words_each: int = 5, similarity: Fraction = Fraction(4, 5), index: int = INDEX
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id of its group), kept (doc_id = component_id); a row per row."""
    stored = cut_lineage(sketches(docs, words_each))
    known = stored.filter(F.col("doc_id").isNotNull())
    same = ["n_shingles", "f1", "f2"]
    classes = cut_lineage(known.filter("n_shingles > 0").groupBy(*same).agg(F.min("doc_id").alias("head")))
    heads = cut_lineage(
        known.join(classes.withColumnRenamed("head", "doc_id"), [*same, "doc_id"], "left_semi").dropDuplicates([*same, "doc_id"])
    )
    links = links_between(heads, docs, words_each, similarity, index)
    members = known.select("doc_id", *same).join(classes, same)
    # A document with several texts joins the classes of all of them.
    double = members.groupBy("doc_id").agg(F.min("head").alias("lo"), F.max("head").alias("hi")).filter("lo < hi")
    ties = members.join(double.select("doc_id"), "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("head").alias("b"))
    groups = components(links.union(ties)).withColumnRenamed("node", "head")
    heads_of = classes.join(groups, "head", "left").select(*same, F.coalesce("component", "head").alias("group"))
    grouped = stored.select("doc_id", *same).join(heads_of, same, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("group", "doc_id"))
    return grouped.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(
    docs: DataFrame, words_each: int = 5, similarity: Fraction = Fraction(4, 5)
) -> DataFrame:
    """The documents that stay: all but those whose group has a smaller doc_id. Columns as before.

    Of rows that repeat doc_id (or have none), source and text, one stays. Such rows are rare: only they are shuffled for it.
    """
    dropped = near_duplicates(docs, words_each, similarity).filter(~F.col("kept")).select("doc_id").distinct()
    row = ROW_KEY[:3]
    keyed = with_row_hash(packed(docs.join(broadcast_if_few(cut_lineage(dropped)), "doc_id", "left_anti").select(*docs.columns)))
    several = cut_lineage(with_row_hash(docs.select("doc_id", "source", "text")).groupBy(*row).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*row))
    several = broadcast_if_few(several)
    once = keyed.join(several, row, "left_anti").select("_doc.*")
    first = keyed.join(several, row, "left_semi").dropDuplicates(row).select("_doc.*")
    return once.union(first)
