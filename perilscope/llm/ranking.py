"""Running sums along a seeded shuffle, without a task that holds a whole source.

A row's place in the shuffle is the MD5 of a seed and its id. The leading digits cut each source into buckets of
about ``BUCKET_ROWS`` rows; sums run inside (source, bucket), and the totals of the earlier buckets are added. Those come
from sums over stretches of ``STRETCH`` buckets and over the stretches, so that no window holds all buckets either.
The order doesn't depend on the number of buckets, so neither does any result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_ROWS = 4096
STRETCH = 1024


def shuffle_key(seed: int, doc_id: Column, otherwise: Column | None = None) -> Column:
    """32 hexadecimal digits; rows without an id are told apart by ``otherwise``, a number, so that they don't share one key."""
    missing = F.lit("null") if otherwise is None else F.concat(F.lit("null:"), otherwise.cast("string"))
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), missing)))


def leading_share(key: Column) -> Column:
    """The key as a number in [0, 1), from its first eight digits."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def bucket_count(rows: int) -> int:
    return max(1, -(-rows // BUCKET_ROWS))


def running(
    df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str], sums: dict[str, Column]
) -> DataFrame:
    """Sums of the earlier rows of the same keys, in the order (bucket, order); keys and bucket aren't NULL."""
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys, bucket).agg(*[F.sum(value).alias(f"_t_{out}") for out, value in sums.items()])
    totals = totals.withColumn("_stretch", F.floor(F.col(bucket) / STRETCH))
    stretches = totals.groupBy(*keys, "_stretch").agg(*[F.sum(f"_t_{out}").alias(f"_s_{out}") for out in sums])
    along = Window.partitionBy(*keys).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy(*keys, "_stretch").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)

    def sum_of(name: str, window) -> Column:
        return F.coalesce(F.sum(name).over(window), F.lit(0))

    ahead = stretches.select(*keys, "_stretch", *[sum_of(f"_s_{out}", along).alias(f"_a_{out}") for out in sums])
    before = totals.withColumns({f"_o_{out}": sum_of(f"_t_{out}", within) for out in sums}).join(ahead, [*keys, "_stretch"])
    before = before.select(*keys, bucket, *[(F.col(f"_o_{out}") + F.col(f"_a_{out}")).alias(f"_o_{out}") for out in sums])
    local = df.withColumns({out: F.coalesce(F.sum(value).over(inside), F.lit(0)) for out, value in sums.items()})
    joined = local.join(before, [*keys, bucket])
    return joined.withColumns({out: F.col(out) + F.col(f"_o_{out}") for out in sums}).drop(*[f"_o_{out}" for out in sums])
