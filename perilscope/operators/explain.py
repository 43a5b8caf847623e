"""Permutation importance of a fitted model over a whole frame, as one job."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perilscope.operators.features import assemble
from perilscope.operators.metrics import areas, curve_of_counts, score_counts
from perilscope.session import cut_lineage

BASE = "none"
BUCKET_ROWS = 50_000


def with_donors(df: DataFrame, columns: Sequence[str], seed: int = 42) -> DataFrame:
    """Add ``donor``: the columns of another row of a hash shuffle.

    Equal rows are numbered, so that content and number are a key of the row. By its hash, rows are dealt to buckets and
    take the next row of their bucket, the last one the first: a random exchange that needs no global order and depends
    on nothing but the rows and ``seed``.
    """
    stored = cut_lineage(df)
    buckets = max(1, stored.count() // BUCKET_ROWS)
    content = F.xxhash64(*df.columns)
    twins = Window.partitionBy("_content", *df.columns).orderBy("_content")
    numbered = stored.withColumn("_content", content).withColumn("_twin", F.row_number().over(twins))
    dealt = numbered.withColumn("_deal", F.pmod(F.xxhash64("_content", "_twin", F.lit(seed)), F.lit(buckets)))
    ring = Window.partitionBy("_deal").orderBy(F.xxhash64("_content", "_twin", F.lit(seed + 1)), *df.columns, "_twin")
    whole = F.struct(*columns)
    start = F.first(whole).over(ring.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return dealt.withColumn("donor", F.coalesce(F.lead(whole).over(ring), start)).drop("_content", "_twin", "_deal")


def permutation_importance(
    df: DataFrame, features: Sequence[str], label: str, score: Callable[[DataFrame], DataFrame], seed: int = 42
) -> DataFrame:
    """Loss of average precision when one feature is exchanged between rows.

    ``score`` adds column ``p`` to a frame with a feature vector. Every row is expanded to one variant per
    feature, scored in the same pass and merged by (feature, score) before the shuffle.
    """
    names = [BASE, *features]
    ready = with_donors(df.select(label, *features), features, seed)
    wide = ready.withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(len(features)))))
    swapped = wide.select(
        label,
        F.element_at(F.array(*[F.lit(n) for n in names]), F.col("variant") + 1).alias("feature"),
        *[
            F.when(F.col("variant") == i, F.col("donor")[c]).otherwise(F.col(c)).cast("double").alias(c)
            for i, c in enumerate(features, 1)
        ],
    )
    scored = score(assemble(swapped, features)).select("feature", label, "p")
    counted = cut_lineage(score_counts(scored, "p", label, ["feature"]))
    ap = areas(curve_of_counts(counted, ["feature"]), ["feature"]).select("feature", "average_precision")
    base = ap.filter(F.col("feature") == BASE).select("average_precision").scalar()
    return ap.filter(F.col("feature") != BASE).select(
        "feature", "average_precision", (base - F.col("average_precision")).alias("importance")
    )
