import itertools
import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from perilscope.operators import anomaly, metrics, profile, resample, sampling, trend
from perilscope.operators.joins import broadcast_if_small, one_row_per_key
from perilscope.operators.prefix import exact_quantiles, positions, running_sums
from perilscope.plans import marts
from perilscope.vocab import EVENT_GROUPS


def skewed(spark, n=600):
    """One key holds most rows, many values repeat."""
    return spark.range(n).select(
        F.when(F.col("id") % 5 != 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 3)).alias("k"),
        (F.pmod(F.xxhash64("id"), F.lit(97)) - 40).cast("double").alias("v"),
        "id",
    )


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums(spark, descending):
    rows = running_sums(skewed(spark), ["k"], "v", {"s": F.col("id")}, descending, then=["id"]).collect()
    for key in {r.k for r in rows}:
        mine = sorted((r for r in rows if r.k == key), key=lambda r: (-r.v if descending else r.v, r.id))
        assert [r.s for r in mine] == list(itertools.accumulate(r.id for r in mine))


def test_positions_without_keys(spark):
    rows = positions(skewed(spark), [], "v", "pos", then=["id"]).collect()
    assert [r.pos for r in sorted(rows, key=lambda r: (r.v, r.id))] == list(range(1, 601))


def test_exact_quantiles(spark):
    frame = skewed(spark)
    shares = [0.0, 0.1, 0.25, 0.5, 0.95, 1.0]
    found = exact_quantiles(frame, ["v", "id"], shares, ["k"]).collect()
    data = frame.toPandas()
    assert len(found) == 2 * data["k"].nunique()
    for row in found:
        expected = np.quantile(data[data["k"] == row.k][row.column_name], shares)
        assert np.allclose([row[f"p{i}"] for i in range(len(shares))], expected)
    assert exact_quantiles(frame.limit(0), ["v"], [0.5]).count() == 0


def brute_trend(t, x):
    n = len(x)
    pairs = [(j, i) for i in range(n) for j in range(i + 1, n)]
    s = sum(int(np.sign(x[j] - x[i])) for j, i in pairs)
    _, ties = np.unique(x, return_counts=True)
    var = (n * (n - 1) * (2 * n + 5) - sum(c * (c - 1) * (2 * c + 5) for c in ties)) / 18
    slope = float(np.median([(x[j] - x[i]) / (t[j] - t[i]) for j, i in pairs]))
    z = 0.0 if s == 0 else (s - np.sign(s)) / math.sqrt(var)
    return s, var, slope, z, math.erfc(abs(z) / math.sqrt(2)), float(np.median(x) - slope * np.median(t))


def series_frame(spark, series):
    rows = [(k, t, float(x)) for k, points in series.items() for t, x in points]
    return spark.createDataFrame(rows, "k string, t bigint, x double")


def test_trend_both_routes_match_brute_force(spark):
    rng = np.random.default_rng(3)
    series = {
        "up": [(t, t * 2 + rng.integers(0, 9)) for t in range(1990, 2021)],
        "flat": [(t, 5) for t in range(2000, 2010)],
        "ties": [(t, rng.integers(0, 4)) for t in range(0, 40)],
        "down": [(3 * t, -0.37 * t + rng.normal()) for t in range(0, 26)],
    }
    frame = series_frame(spark, series)
    for short in (512, 28):
        found = {r.k: r for r in trend.mann_kendall(frame, ["k"], "t", "x", short=short).collect()}
        assert set(found) == set(series)
        for key, points in series.items():
            s, var, slope, z, p, intercept = brute_trend(*map(np.array, zip(*points)))
            row = found[key]
            assert (row.n, row.s) == (len(points), s)
            assert row.var_s == pytest.approx(var) and row.z == pytest.approx(z)
            assert row.p == pytest.approx(p, abs=3e-7)
            assert row.slope == pytest.approx(slope, rel=1e-12, abs=1e-300)
            assert row.intercept == pytest.approx(intercept, rel=1e-6, abs=1e-6)
        assert found["up"].trend == "increasing" and found["down"].trend == "decreasing"
        assert found["flat"].trend == "no trend" and found["flat"].s == 0


def test_zero_median_slope_is_exact_on_both_routes(spark):
    frame = series_frame(spark, {"zigzag": [(t, t % 2) for t in range(12)], "late": [(2000 + t, 0 if t < 9 else -t) for t in range(12)]})
    for short in (512, 5):
        found = {r.k: r for r in trend.mann_kendall(frame, ["k"], "t", "x", short=short).collect()}
        assert found["zigzag"].slope == 0.0 and found["zigzag"].intercept == 0.5
        assert found["late"].slope == 0.0


def test_fractional_periods_on_both_routes(spark):
    rng = np.random.default_rng(8)
    times = np.cumsum(rng.random(60) + 0.01)
    series = {"a": [(float(t), float(v)) for t, v in zip(times, 0.3 * times + rng.normal(size=60))], "b": [(t / 2, float(t % 3)) for t in range(40)]}
    frame = spark.createDataFrame([(k, t, x) for k, points in series.items() for t, x in points], "k string, t double, x double")
    for short in (512, 10):
        for row in trend.mann_kendall(frame, ["k"], "t", "x", short=short).collect():
            s, _, slope, z, _, intercept = brute_trend(*map(np.array, zip(*series[row.k])))
            assert row.s == s and row.slope == pytest.approx(slope, rel=1e-14) and row.intercept == pytest.approx(intercept, rel=1e-9)


def test_selected_slopes_are_real_ones(spark, monkeypatch):
    """Few drawn pairs and a low limit make several rounds; ties, one value and outliers among them."""
    monkeypatch.setattr(trend, "DRAWN", 200)
    monkeypatch.setattr(trend, "DRAWN_PER_POINT", 0)
    monkeypatch.setattr(trend, "WRITTEN_PER_POINT", 1)
    rng = np.random.default_rng(5)
    t = np.arange(150)
    series = {
        "noise": rng.normal(size=150).cumsum(), "grid": rng.integers(0, 5, 150).astype(float), "steps": (t // 10).astype(float),
        "flat": np.full(150, 7.5), "line": 2.5 * t - 3, "heavy": rng.standard_cauchy(150) * 1e6,
    }
    frame = series_frame(spark, {k: list(zip(t.tolist(), x.tolist())) for k, x in series.items()})
    found = {r.k: r.slope for r in trend.mann_kendall(frame, ["k"], "t", "x", short=20).collect()}
    for k, x in series.items():
        slopes = np.sort([(x[j] - x[i]) / (t[j] - t[i]) for i in range(150) for j in range(i + 1, 150)])
        low, high = slopes[(len(slopes) - 1) // 2], slopes[len(slopes) // 2]
        assert found[k] == low + (high - low) * 0.5, k


def test_trend_is_antisymmetric_and_handles_one_point(spark):
    points = [(t, (t * 37) % 11) for t in range(15)]
    mirrored = [(14 - t, x) for t, x in points]
    found = {r.k: r for r in trend.mann_kendall(series_frame(spark, {"a": points, "b": mirrored, "one": [(1, 2)]}), ["k"], "t", "x").collect()}
    assert found["a"].s == -found["b"].s and found["a"].slope == pytest.approx(-found["b"].slope)
    assert found["one"].s == 0 and found["one"].slope is None and found["one"].trend == "no trend"


def test_inversions_with_one_heavy_series(spark):
    rng = np.random.default_rng(5)
    values = rng.integers(0, 30, 300)
    frame = spark.createDataFrame([("h", int(t), float(v)) for t, v in enumerate(values)], "k string, t bigint, x double")
    row = trend.inversions(frame, ["k"], "t", "x").first()
    pairs = [(values[i], values[j]) for i in range(300) for j in range(i + 1, 300)]
    assert row.inverted == sum(a > b for a, b in pairs) and row.tied_pairs == sum(a == b for a, b in pairs)


def test_planted_outlier_is_most_anomalous_whatever_the_partitioning(spark):
    rows = [(i, float(100 + i % 7), float(10 + i % 5)) for i in range(200)] + [(999, 1e6, 500.0)]
    frame = spark.createDataFrame(rows, "id bigint, a double, b double")
    first = anomaly.score_anomalies(frame.repartition(3), ["a", "b"], ["id"], trees=30).toPandas()
    second = anomaly.score_anomalies(frame.repartition(7), ["a", "b"], ["id"], trees=30).toPandas()
    first, second = (d.set_index("id").sort_index() for d in (first, second))
    assert first["anomaly_raw_score"].idxmin() == 999 and first.loc[999, "anomaly_score"] == -1
    assert np.allclose(first["anomaly_raw_score"], second["anomaly_raw_score"])
    assert first["anomaly_raw_score"].between(-1, 0).all()
    assert 1 <= (first["anomaly_score"] == -1).sum() <= 60


def test_curve_areas_are_invariant_under_monotone_maps(spark):
    frame = spark.range(500).select(
        (F.pmod(F.xxhash64("id"), F.lit(50)) / 50.0).alias("s"), (F.col("id") % 7 == 0).cast("int").alias("y")
    )
    stretched = frame.withColumn("s", F.exp(F.col("s") * 3))
    a = metrics.areas(metrics.curve(frame, "s", "y")).first()
    b = metrics.areas(metrics.curve(stretched, "s", "y")).first()
    assert tuple(a) == pytest.approx(tuple(b))
    perfect = frame.withColumn("s", F.col("y").cast("double"))
    best = metrics.areas(metrics.curve(perfect, "s", "y")).first()
    assert best.average_precision == pytest.approx(1.0) and best.roc_auc == pytest.approx(1.0)


def test_threshold_fallback_is_full_recall(spark):
    frame = spark.range(300).select((F.col("id") / 300.0).alias("s"), (F.col("id") == 0).cast("int").alias("y"))
    found = metrics.thresholds(metrics.curve(frame, "s", "y"), precision_floor=0.5).first()
    assert found.max_recall_threshold == 0.0 and found.recall_at_floor is None


def ladder(counts):
    """The declared tie order, written out."""
    t, f, w, h = (counts[g] for g in ("TORNADO", "FLOOD", "WIND", "HURRICANE"))
    rest = [counts[g] for g in EVENT_GROUPS if g not in ("TORNADO", "FLOOD", "WIND", "HURRICANE")]
    if t >= max(f, w, h, *rest):
        return "TORNADO"
    if f >= max(h, w, *rest):
        return "FLOOD"
    if w >= max(h, *rest):
        return "WIND"
    return "HURRICANE" if h >= max(rest) else "WINTER_STORM"


def test_dominant_group(spark):
    rng = np.random.default_rng(1)
    rows = [tuple(int(v) for v in rng.integers(0, 4, len(EVENT_GROUPS))) for _ in range(2000)]
    rows.append(tuple(0 for _ in EVENT_GROUPS))
    frame = spark.createDataFrame(rows, ", ".join(f"n_{g} bigint" for g in EVENT_GROUPS))
    found = frame.select("*", marts.dominant_group().alias("d"), marts.dominant_group("exact").alias("e")).collect()
    for row in found:
        counts = {g: row[f"n_{g}"] for g in EVENT_GROUPS}
        assert row.d == ladder(counts)
        assert (row.e is None) if max(counts.values()) == 0 else counts[row.e] == max(counts.values())


def brute_neighbours(rows, k):
    """Sorted distances to the k nearest other rows, per distinct row."""
    data = np.array(rows)
    out = {}
    for i, point in enumerate(data):
        distance = np.sqrt(((data - point) ** 2).sum(axis=1))
        out[tuple(point)] = np.sort(np.delete(distance, i))[:k]
    return out


@pytest.mark.parametrize("spread", [1.0, 1000.0])
def test_nearest_points_are_exact(spark, monkeypatch, spread):
    monkeypatch.setattr(resample, "BLOCK", 16)
    rng = np.random.default_rng(2)
    rows = [(float(rng.integers(0, 12)), float(rng.integers(0, 5)), float(np.round(rng.normal() * spread))) for _ in range(150)]
    rows += [(1.0, 1.0, 0.0)] * 40
    frame = spark.createDataFrame(rows, "a double, b double, c double")
    points = resample.merged_points(frame, ["a", "b", "c"])
    near = resample.nearest_points(points, 5).join(points.select("id", "x"), "id").collect()
    expected = brute_neighbours(rows, 5)
    assert len(near) == len(expected)
    for row in near:
        flat = [n["distance"] for n in row.near for _ in range(n["copies"] - (n["other"] == row.id))]
        assert np.allclose(flat[:5], expected[tuple(row.x)])


def test_tied_projections_take_no_more_rounds(spark, monkeypatch):
    monkeypatch.setattr(resample, "BLOCK", 16)
    rows = [(float(i), float(-i)) for i in range(300)]
    points = resample.merged_points(spark.createDataFrame(rows, "a double, b double"), ["a", "b"])
    calls = []
    compared = resample._compared
    monkeypatch.setattr(resample, "_compared", lambda *a: calls.append(1) or compared(*a))
    near = resample.nearest_points(points, 3).join(points.select("id", "x"), "id").collect()
    expected = brute_neighbours(rows, 3)
    assert len(calls) == 2 and len(near) == 300
    for row in near:
        flat = [n["distance"] for n in row.near for _ in range(n["copies"] - (n["other"] == row.id))]
        assert np.allclose(flat[:3], expected[tuple(row.x)])


def test_synthetic_rows_lie_between_neighbours(spark):
    rng = np.random.default_rng(4)
    rows = [(float(v), float(w)) for v, w in rng.integers(0, 20, (60, 2))] + [(3.0, 3.0)] * 50
    frame = spark.createDataFrame(rows, "a double, b double")
    made = resample.synthetic_rows(frame, ["a", "b"], 333, k=5, seed=1).collect()
    assert len(made) == 333
    assert all(0 <= r.a <= 19 and 0 <= r.b <= 19 for r in made)
    again = resample.synthetic_rows(frame.repartition(5), ["a", "b"], 333, k=5, seed=1).collect()
    assert sorted(made) == sorted(again)
    assert resample.synthetic_rows(frame, ["a", "b"], 0).count() == 0


def test_sample_is_independent_of_partitioning(spark):
    frame = spark.range(5000)
    a = {r.id for r in sampling.seeded_sample(frame.repartition(7), ["id"], 100).collect()}
    b = {r.id for r in sampling.seeded_sample(frame.repartition(3), ["id"], 100).collect()}
    assert a == b and len(a) == 100


def test_histogram_edges_and_skewness(spark):
    frame = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (None,)], "x double")
    assert {r.bin: r.n for r in profile.histogram(frame, F.col("x"), 3).collect()} == {1: 2, 3: 1}
    assert profile.histogram(frame.filter("x = 1"), F.col("x")).collect()[0].asDict() == {"bin": 1, "n": 1}
    d = np.array([1.0, 2.0, 10.0]) - 13 / 3
    corrected = (d**3).mean() / (d**2).mean() ** 1.5 * math.sqrt(3 * 2) / (3 - 2)
    assert profile.skewness_raw_and_log(frame, ["x"]).first().skewness == pytest.approx(corrected, abs=1e-6)


def test_one_row_per_key_and_checked_broadcast(spark):
    frame = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", None, "z")], "k string, n int, v string")
    assert {tuple(r) for r in one_row_per_key(frame, ["k"], ["n"]).collect()} == {("a", 2, "y"), ("b", None, "z")}
    assert "ResolvedHint" in broadcast_if_small(frame)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in broadcast_if_small(frame, max_rows=2)._jdf.queryExecution().analyzed().toString()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-5, 5)), min_size=1, max_size=40))
def test_running_sum_property(spark, pairs):
    rows = [(f"k{k}", float(v), i) for i, (k, v) in enumerate(pairs)]
    frame = spark.createDataFrame(rows, "k string, v double, i bigint")
    found = running_sums(frame, ["k"], "v", {"s": F.lit(1).cast("bigint")}, then=["i"]).collect()
    for key in {r.k for r in found}:
        mine = sorted((r for r in found if r.k == key), key=lambda r: (r.v, r.i))
        assert [r.s for r in mine] == list(range(1, len(mine) + 1))


def test_a_summary_taken_at_once_gives_the_same_weights(spark):
    from perilscope.operators import features as ft

    rows = [(k, "ab"[k % 2], None if k % 5 == 0 else k % 3, float(k % 4 == 0)) for k in range(60)]
    frame = spark.createDataFrame(rows, "id bigint, kind string, place int, label double")
    lazy = ft.known(ft.label_summary(frame, "label", ["kind", "place"]))
    taken = ft.known(ft.label_summary(frame, "label", ["kind", "place"]), now=True)
    found = []
    for seen in (None, lazy, taken):
        df = ft.positive_weights(ft.balanced_weights(frame, "label", "w1", seen), "label", "w2", seen)
        df = ft.danger_weights(df, "kind", "label", "w3", seen)
        found.append(sorted(tuple(r) for r in ft.target_encode(frame, df, {"kind": "r1", "place": "r2"}, "label", seen).select("id", "w1", "w2", "w3", "r1", "r2").collect()))
    assert found[0] == found[1] == found[2]
    positive, of_a = [r for r in rows if r[3]], [r for r in rows if r[1] == "a"]
    first = found[0][0]
    assert first[1:] == pytest.approx((60 / (2 * len(positive)), 45 / 15, 45 / 15 * 5, sum(r[3] for r in of_a) / len(of_a), 0.25))
