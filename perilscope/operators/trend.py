"""Monotone trend of many time series in one job: Mann-Kendall test and Sen's slope.

A series is one row per (keys, period). Series of up to ``SHORT`` points are packed into one row each and
tested with array expressions inside the JVM. Longer ones are never gathered: the sign sum is an inversion
count done with distributed running sums, and the median slope is selected with the same count among real pair slopes.
Periods differ within a series; values are not NULL. Both routes give the same numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilscope.functions.scalars import normal_cdf
from perilscope.operators.prefix import exact_quantiles, positions, running_sums
from perilscope.session import cut_lineage

SHORT = 512
SIGNIFICANT = 0.05

# Selection of a slope by rank: rounds, pairs drawn per round (and per point on top), how many deviations of the drawn
# rank lie between the pivots, and the pairs per point that may be written out in the end.
ROUNDS = 5
DRAWN = 1 << 16
DRAWN_PER_POINT = 4
DEVIATIONS = 3.0
WRITTEN_PER_POINT = 64
BLOCK = 64  # ranks in a block of the last join


def _median(values: Column) -> Column:
    ordered = F.sort_array(values)
    size = F.size(values)
    low = F.get(ordered, F.floor((size - 1) / 2).cast("int"))
    high = F.get(ordered, F.floor(size / 2).cast("int"))
    return low + (high - low) * 0.5


def _short_statistics(series: DataFrame, keys: Sequence[str], period: str, value: str) -> DataFrame:
    """S, tie term, slope and medians per series from one sorted array per row."""
    point = F.struct(F.col(period).cast("double").alias("t"), F.col(value).cast("double").alias("x"))
    packed = series.groupBy(*keys).agg(F.sort_array(F.collect_list(point)).alias("pts"))
    pts = F.col("pts")
    n = F.size(pts)
    places = F.sequence(F.lit(1), n)

    def sign_sum(i: Column) -> Column:
        here = F.get(pts, i - 1)["x"]
        later = F.slice(pts, i + 1, n)
        return F.aggregate(later, F.lit(0).cast("bigint"), lambda a, b: a + F.signum(b["x"] - here).cast("bigint"))

    def slopes(i: Column) -> Column:
        here = F.get(pts, i - 1)
        return F.transform(F.slice(pts, i + 1, n), lambda b: (b["x"] - here["x"]) / (b["t"] - here["t"]))

    values = F.transform(pts, lambda p: p["x"])
    ties = F.transform(
        F.array_distinct(values), lambda v: F.size(F.filter(values, lambda w: w == v)).cast("bigint")
    )
    zero = F.lit(0).cast("bigint")
    return packed.select(
        *keys,
        n.cast("bigint").alias("n"),
        F.aggregate(places, zero, lambda a, i: a + sign_sum(i)).alias("s"),
        F.aggregate(ties, zero, lambda a, c: a + c * (c - 1) * (2 * c + 5)).alias("tie_term"),
        _median(F.flatten(F.transform(places, slopes))).alias("slope"),
        _median(values).alias("median_value"),
        _median(F.transform(pts, lambda p: p["t"])).alias("median_period"),
    )


def inversions(points: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """Per key: points, pairs whose later value is smaller, pairs of equal values, and the tie term.

    Values become dense ranks. Two ranks differ first at one bit; at that bit, among points that agree above
    it, an inverted pair is a 1 before a 0. So the count is a running sum of ones per (bit, higher bits).
    Work is points x bits; no pair is ever formed.
    """
    keys = list(keys)
    counted = points.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    ranked = running_sums(counted, keys, value, {"_rank": F.lit(1).cast("bigint")})
    c = F.col("_c")
    totals = counted.groupBy(*keys).agg(
        F.sum(c).alias("n"),
        F.sum(c * (c - 1) / 2).cast("bigint").alias("tied_pairs"),
        F.sum(c * (c - 1) * (2 * c + 5)).alias("tie_term"),
        F.count(F.lit(1)).alias("_values"),
    )
    bits = int(totals.agg(F.max("_values")).first()[0] or 1).bit_length()
    placed = points.select(*keys, order, value).join(ranked.select(*keys, value, "_rank"), [*keys, value])
    levels = placed.select(*keys, order, "_rank", F.explode(F.sequence(F.lit(0), F.lit(bits - 1))).alias("_level"))
    levels = levels.select(
        *keys,
        order,
        "_level",
        F.expr("shiftright(_rank, _level + 1)").alias("_above"),
        F.expr("shiftright(_rank, _level) & 1").alias("_bit"),
    )
    summed = running_sums(levels, [*keys, "_level", "_above"], order, {"_ones": F.col("_bit")})
    inverted = summed.filter(F.col("_bit") == 0).groupBy(*keys).agg(F.sum("_ones").alias("inverted"))
    return totals.drop("_values").join(inverted, keys, "left").fillna(0, ["inverted"])


def _drawn_slopes(placed: DataFrame, sizes: DataFrame, keys: list[str], turn: int) -> DataFrame:
    """keys, slope: slopes of pairs of points chosen by a hash of the series, the turn and a counter."""
    piece = 1 << 14
    pieces = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") * DRAWN_PER_POINT + DRAWN) / piece)))
    spread = sizes.select(*keys, "n", pieces.alias("_piece")).repartition(*keys, "_piece")
    numbers = spread.select(*keys, "n", F.explode(F.sequence(F.col("_piece") * piece, (F.col("_piece") + 1) * piece - 1)).alias("_k"))

    def chosen(side: int) -> Column:
        return F.pmod(F.xxhash64(*keys, F.lit(turn), F.lit(side), "_k"), F.col("n")) + 1

    pairs = numbers.select(*keys, "_k", chosen(0).alias("_u"), chosen(1).alias("_v")).filter("_u < _v")
    point = F.struct("t", "x")
    left = placed.select(*keys, F.col("pos").alias("_u"), point.alias("_a"))
    right = placed.select(*keys, F.col("pos").alias("_v"), point.alias("_b"))
    slope = (F.col("_b.x") - F.col("_a.x")) / (F.col("_b.t") - F.col("_a.t"))
    return pairs.join(left, [*keys, "_u"]).join(right, [*keys, "_v"]).select(*keys, slope.alias("slope"))


def _at_ranks(values: DataFrame, keys: list[str], wanted: Sequence[str], value: str) -> DataFrame:
    """Per key the values at the ranks (from 1) in the columns ``wanted``; those columns are replaced by the values found."""
    counted = cut_lineage(values.groupBy(*keys, *wanted, value).agg(F.count(F.lit(1)).alias("_c")))
    upto = running_sums(counted, [*keys, *wanted], value, {"_upto": F.col("_c")})

    def found(name: str) -> Column:
        return F.max(F.when((F.col("_upto") >= F.col(name)) & (F.col("_upto") - F.col("_c") < F.col(name)), F.col(value)))

    named = [found(name).alias(f"_v_{name}") for name in wanted]
    return upto.groupBy(*keys, *wanted).agg(*named).drop(*wanted).withColumnsRenamed({f"_v_{name}": name for name in wanted})


def _tilted(points: DataFrame, tilts: DataFrame, keys: list[str], label: Sequence[str]) -> DataFrame:
    """The points of each tilt's series with z = x - m t, both counted from the first point."""
    turned = points.join(tilts, keys)
    return turned.select(*keys, *label, "t", "x", (F.col("x") - F.col("x0") - F.col("m") * (F.col("t") - F.col("t0"))).alias("z"))


def _pivots(state: DataFrame, drawn: DataFrame, keys: list[str]) -> DataFrame:
    """Two real slopes around the rank for each open state, from the drawn slopes between its bounds; none drawn: the middle."""
    key = [*keys, "rank"]
    inside = state.drop("slope").join(drawn, keys).filter((F.col("slope") > F.col("low")) & (F.col("slope") < F.col("high")))
    counts = inside.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    place = F.col("_n") * (F.col("rank") - F.col("c_low")) / (F.col("c_high") - F.col("c_low"))
    slack = DEVIATIONS / 2 * F.sqrt("_n")
    ranked = inside.join(counts, key).select(
        *key,
        "slope",
        F.greatest(F.floor(place - slack), F.lit(1)).alias("first"),
        F.least(F.ceil(place + slack), F.col("_n")).alias("second"),
    )
    found = _at_ranks(ranked, key, ["first", "second"], "slope")
    middle = (F.col("low") + F.col("high")) / 2
    both = F.array_distinct(F.array(F.coalesce("first", middle), F.coalesce("second", middle)))
    return state.join(found, key, "left").select(*key, F.explode(both).alias("pivot"))


def _narrowed(state: DataFrame, pivots: DataFrame, points: DataFrame, keys: list[str]) -> DataFrame:
    """The states with their bounds moved to tilts just below and above the pivots, by the number of slopes below each tilt.

    They are apart from it by more than rounding can turn a pair. Where the rank lies within such a margin and that isn't a
    few pairs, all those slopes are the pivot, which is kept as ``slope``.
    """
    key = [*keys, "rank"]

    def margin(slope: Column) -> Column:
        return F.greatest(F.col("noise") + F.abs(slope) * F.col("noise_per_slope"), F.lit(1e-300))

    tried = state.join(pivots, key).select(*key, "noise", "noise_per_slope", "pivot", F.explode(F.array(F.lit(-1), F.lit(1))).alias("side"))
    tried = tried.withColumn("m", F.col("pivot") + F.col("side") * margin(F.col("pivot")))
    tried = cut_lineage(tried.select(*key, "pivot", "side", "m"))
    tilted = cut_lineage(_tilted(points, tried, keys, ["rank", "pivot", "side"]))
    below = inversions(tilted, [*key, "pivot", "side"], "t", "z").select(*key, "pivot", "side", F.col("inverted").alias("c"))
    counted = tried.join(below, [*key, "pivot", "side"]).select(*key, F.struct("m", "c", "pivot").alias("tilt"))
    bounds = state.select(*key, F.explode(F.array(F.struct(F.col("low").alias("m"), F.col("c_low").alias("c"), F.lit(None).cast("double").alias("pivot")),
                                                  F.struct(F.col("high").alias("m"), F.col("c_high").alias("c"), F.lit(None).cast("double").alias("pivot")))).alias("tilt"))
    every = counted.unionByName(bounds)
    low = F.max(F.when(F.col("tilt.c") < F.col("rank"), F.col("tilt")))
    high = F.min(F.when(F.col("tilt.c") >= F.col("rank"), F.col("tilt")))
    moved = every.groupBy(*key).agg(low.alias("_low"), high.alias("_high"))
    left = F.col("_high.c") - F.col("_low.c")
    pivot = F.coalesce("_low.pivot", "_high.pivot")
    tied = (F.col("_high.m") - F.col("_low.m") < 2.5 * margin(pivot)) & (left > F.col("limit"))
    fixed = ["noise", "noise_per_slope", "limit"]
    return state.select(*key, *fixed).join(moved, key).select(
        *key, *fixed,
        F.col("_low.m").alias("low"), F.col("_high.m").alias("high"), F.col("_low.c").alias("c_low"), F.col("_high.c").alias("c_high"),
        F.when(tied, pivot).alias("slope"),
    )


def _written_out(state: DataFrame, points: DataFrame, keys: list[str]) -> DataFrame:
    """keys, rank, slope: the slopes between the bounds of each state, written out, and the one at the rank.

    Ordered by z at both bounds, a pair between them changes its order. The stretches between the two ranks of its points then
    overlap, and at most twice the root of the pairs sought cross any one place. So points meet in blocks of ranks that
    their stretches touch, a pair in the block where its overlap begins.
    """
    key = [*keys, "rank"]
    ends = F.array(F.struct(F.lit("a").alias("end"), F.col("low").alias("m")), F.struct(F.lit("b").alias("end"), F.col("high").alias("m")))
    tilts = state.select(*key, F.explode(ends).alias("_e")).select(*key, "_e.*")
    turned = cut_lineage(_tilted(points, tilts, keys, ["rank", "end"]))
    ranked = running_sums(turned, [*key, "end"], "z", {"pos": F.lit(1).cast("bigint")}, then=["t"])
    both = ranked.groupBy(*key, "t", "x").agg(
        F.max(F.when(F.col("end") == "a", F.col("pos"))).alias("a"), F.max(F.when(F.col("end") == "b", F.col("pos"))).alias("b")
    )
    start, stop = F.least("a", "b"), F.greatest("a", "b")
    blocks = F.explode(F.sequence(F.floor(start / BLOCK), F.floor(stop / BLOCK))).alias("block")
    touched = cut_lineage(both.select(*key, "t", "x", "a", "b", start.alias("start"), blocks))
    one, other = touched.alias("l"), touched.alias("r")
    same = F.lit(True)
    for name in (*key, "block"):
        same = same & (F.col(f"l.{name}") == F.col(f"r.{name}"))
    crossed = (F.col("l.a") < F.col("r.a")) & (F.col("l.b") > F.col("r.b"))
    here = F.floor(F.greatest("l.start", "r.start") / BLOCK) == F.col("l.block")
    slope = (F.col("r.x") - F.col("l.x")) / (F.col("r.t") - F.col("l.t"))
    pairs = one.join(other, same & crossed & here).select(*[F.col(f"l.{name}") for name in key], slope.alias("slope"))
    sought = pairs.join(state.select(*key, (F.col("rank") - F.col("c_low")).alias("sought")), key)
    return _at_ranks(sought, key, ["sought"], "slope").withColumnRenamed("sought", "slope")


def _median_slopes(points: DataFrame, keys: list[str]) -> DataFrame:
    """Median of all pair slopes per series: a real slope, or the middle of the two middle ones.

    A slope is below m exactly when ``x - m t`` falls from its first to its second point, so slopes below m are an inversion count. Pivots are
    slopes of drawn pairs; each round keeps the slopes between two of them. What is left in the end is written out.
    """
    placed = cut_lineage(positions(points, keys, "t", "pos"))
    following = placed.select(*keys, (F.col("pos") - 1).alias("pos"), F.col("t").alias("next"))
    gaps = placed.join(following, [*keys, "pos"]).groupBy(*keys).agg(F.min(F.col("next") - F.col("t")).alias("gap"))
    ends = placed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("t").alias("t0"), F.max("t").alias("t1"), F.min("x").alias("x0"), F.max("x").alias("x1")
    )
    ends = cut_lineage(ends.join(gaps, keys))
    points = cut_lineage(points.join(ends.select(*keys, "t0", "x0"), keys))
    pairs = F.floor(F.col("n") * (F.col("n") - 1) / 2).cast("bigint")
    steepest = (F.col("x1") - F.col("x0")) / F.col("gap") * 2 + 1
    rounding = 2.0**-49 / F.col("gap")
    state = ends.select(
        *keys,
        F.explode(F.array_distinct(F.array(F.floor((pairs + 1) / 2), F.floor((pairs + 2) / 2)))).alias("rank"),
        ((F.col("x1") - F.col("x0")) * rounding).alias("noise"),
        ((F.col("t1") - F.col("t0")) * rounding).alias("noise_per_slope"),
        (F.col("n") * WRITTEN_PER_POINT).alias("limit"),
        (-steepest).alias("low"),
        steepest.alias("high"),
        F.lit(0).cast("bigint").alias("c_low"),
        pairs.alias("c_high"),
        F.lit(None).cast("double").alias("slope"),
    )
    state = cut_lineage(state)
    many = F.col("slope").isNull() & (F.col("c_high") - F.col("c_low") > F.col("limit"))
    for turn in range(ROUNDS):
        open_ = state.filter(many)
        if open_.isEmpty():
            break
        drawn = cut_lineage(_drawn_slopes(placed, ends.join(open_.select(*keys).distinct(), keys), keys, turn))
        pivots = cut_lineage(_pivots(open_, drawn, keys))
        state = cut_lineage(state.filter(~many).unionByName(_narrowed(open_, pivots, points, keys)))
    rest = state.filter(F.col("slope").isNull())
    found = state.filter(F.col("slope").isNotNull()).select(*keys, "rank", "slope").unionByName(_written_out(rest, points, keys))
    low, high = F.min_by("slope", "rank"), F.max_by("slope", "rank")
    return found.groupBy(*keys).agg((low + (high - low) * 0.5).alias("slope"))


def _long_statistics(series: DataFrame, keys: Sequence[str], period: str, value: str) -> DataFrame:
    keys = list(keys)
    points = cut_lineage(series.select(*keys, F.col(period).cast("double").alias("t"), F.col(value).cast("double").alias("x")))
    found = cut_lineage(inversions(points, keys, "t", "x"))
    medians = exact_quantiles(points, ["x", "t"], [0.5], keys).groupBy(*keys)
    medians = medians.agg(
        F.max(F.when(F.col("column_name") == "x", F.col("p0"))).alias("median_value"),
        F.max(F.when(F.col("column_name") == "t", F.col("p0"))).alias("median_period"),
    )
    n = F.col("n")
    s = (n * (n - 1) / 2).cast("bigint") - F.col("tied_pairs") - 2 * F.col("inverted")
    return (
        found.select(*keys, "n", s.alias("s"), "tie_term")
        .join(_median_slopes(points, keys), keys, "left")
        .join(medians, keys)
    )


def mann_kendall(
    series: DataFrame, keys: Sequence[str], period: str, value: str, short: int = SHORT
) -> DataFrame:
    """Trend, p, z, tau, S, var(S), Sen slope and intercept per series."""
    keys = list(keys)
    series = cut_lineage(series.select(*keys, period, value))
    lengths = series.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    longest = lengths.agg(F.max("_n")).first()[0] or 0
    if longest <= short:
        base = _short_statistics(series, keys, period, value)
    else:
        measured = series.join(lengths, keys)
        base = _short_statistics(measured.filter(F.col("_n") <= short), keys, period, value).unionByName(
            _long_statistics(measured.filter(F.col("_n") > short), keys, period, value)
        )
    n, s = F.col("n"), F.col("s")
    variance = (n * (n - 1) * (2 * n + 5) - F.col("tie_term")).cast("double") / 18
    z = F.when(s == 0, F.lit(0.0)).otherwise(F.try_divide((s - F.signum(s)).cast("double"), F.sqrt("var_s")))
    p = 2 * (1 - normal_cdf(F.abs("z")))
    trend = F.when((F.col("p") < SIGNIFICANT) & (F.col("z") > 0), "increasing").when(
        (F.col("p") < SIGNIFICANT) & (F.col("z") < 0), "decreasing"
    )
    return (
        base.withColumn("var_s", variance)
        .withColumn("tau", F.try_divide(s.cast("double"), n * (n - 1) / 2))
        .withColumn("z", z)
        .withColumn("p", p)
        .withColumn("trend", trend.otherwise("no trend"))
        .withColumn("intercept", F.col("median_value") - F.col("slope") * F.col("median_period"))
        .select(*keys, "n", "trend", "p", "z", "tau", "s", "var_s", "slope", "intercept")
    )


def mark_peak(series: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Flag the period with the largest value of each series, so it can be shown apart."""
    peak = series.groupBy(*keys).agg(F.max(value).alias("_peak"))
    joined = series.join(peak, list(keys)) if keys else series.withColumn("_peak", series.agg(F.max(value)).scalar())
    return joined.withColumn("is_outlier", F.col(value) == F.col("_peak")).drop("_peak")
