"""Running totals, row positions and exact quantiles that never sort a whole group in one task.

Rows are cut into order buckets at approximate quantiles of the order column. Sums run inside
(key, bucket) and the totals of the earlier buckets are added, so even a single key is spread over all tasks.
Any cut points give the same result; good ones only balance the work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perilscope.session import cut_lineage, shuffle_width

BUCKET = "_bucket"


def cut_points(df: DataFrame, order: str) -> list[float]:
    """At most one value per shuffle partition; the only thing collected."""
    width = shuffle_width(df.sparkSession)
    shares = [i / width for i in range(1, width)]
    if not shares:
        return []
    found = df.agg(F.percentile_approx(F.col(order).cast("double"), shares, 10_000).alias("q")).first()["q"]
    return sorted(set(found or []))


def order_buckets(df: DataFrame, order: str) -> DataFrame:
    cuts = cut_points(df, order)
    if not cuts:
        return df.withColumn(BUCKET, F.lit(0))
    splits = [-float("inf"), *cuts, float("inf")]
    source = "_order"
    binner = Bucketizer(splits=splits, inputCol=source, outputCol="_b", handleInvalid="keep")
    binned = binner.transform(df.withColumn(source, F.col(order).cast("double")))
    return binned.withColumn(BUCKET, F.col("_b").cast("int")).drop(source, "_b")


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: dict[str, Column],
    descending: bool = False,
    then: Sequence[str] = (),
) -> DataFrame:
    """Add cumulative sums per key in ``order`` (numeric, not NULL; keys not NULL).

    (key, order, then) must identify a row for the sums to be repeatable.
    """
    keys = list(keys)

    def towards(name: str) -> Column:
        return F.col(name).desc() if descending else F.col(name).asc()

    bucketed = order_buckets(df, order)
    inside = (
        Window.partitionBy(*keys, BUCKET)
        .orderBy(towards(order), *then)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = Window.partitionBy(*keys).orderBy(towards(BUCKET)).rowsBetween(Window.unboundedPreceding, -1)
    totals = bucketed.groupBy(*keys, BUCKET).agg(*[F.sum(value).alias(f"_t_{out}") for out, value in sums.items()])
    offsets = totals.select(
        *keys,
        BUCKET,
        *[F.coalesce(F.sum(f"_t_{out}").over(earlier), F.lit(0)).alias(f"_o_{out}") for out in sums],
    )
    local = bucketed.withColumns({out: F.sum(value).over(inside) for out, value in sums.items()})
    joined = local.join(offsets, [*keys, BUCKET])
    return joined.withColumns({out: F.col(out) + F.col(f"_o_{out}") for out in sums}).drop(
        BUCKET, *[f"_o_{out}" for out in sums]
    )


def positions(df: DataFrame, keys: Sequence[str], order: str, out: str, then: Sequence[str] = ()) -> DataFrame:
    """Row number per key, starting at 1."""
    return running_sums(df, keys, order, {out: F.lit(1).cast("bigint")}, then=then)


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], keys: Sequence[str] = ()
) -> DataFrame:
    """Linear-interpolation quantiles per (keys, column), one output column ``p<i>`` per probability.

    Equal values are merged before the shuffle and stored, so the source is read once. NULLs are left out. Keys must not be NULL.
    """
    group = [*keys, "column_name"]
    long = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    long = long.unpivot(list(keys), list(columns), "column_name", "value").filter(F.col("value").isNotNull())
    counted = cut_lineage(long.groupBy(*group, "value").agg(F.count(F.lit(1)).alias("n")))
    upto = running_sums(counted, group, "value", {"upto": F.col("n")})
    sizes = counted.groupBy(*group).agg(F.sum("n").alias("total"))
    ranked = upto.join(sizes, group)
    aggregates = []
    for i, p in enumerate(probabilities):
        place = (F.col("total") - 1) * F.lit(float(p))
        for side, at in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            here = (F.col("upto") - F.col("n") <= at) & (at < F.col("upto"))
            aggregates.append(F.max(F.when(here, F.col("value"))).alias(f"_{side}{i}"))
        aggregates.append(F.max(place - F.floor(place)).alias(f"_f{i}"))
    picked = ranked.groupBy(*group).agg(*aggregates)
    return picked.select(
        *group,
        *[
            (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(f"p{i}")
            for i in range(len(probabilities))
        ],
    )


def quantile_value(df: DataFrame, column: str, probability: float, exact: bool = True) -> float | None:
    """One quantile as a number; ``exact=False`` uses the sketch."""
    if exact:
        row = exact_quantiles(df, [column], [probability]).select("p0").first()
    else:
        row = df.agg(F.percentile_approx(F.col(column).cast("double"), probability, 10_000)).first()
    return None if row is None else row[0]
