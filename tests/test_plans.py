"""Properties of the composed jobs on the smallest shared data."""

import pytest
from pyspark.sql import functions as F

from perilscope.operators import explain, metrics, models, quality
from perilscope.operators import features as ft
from perilscope.operators.scaling import fit_scaling, scale
from perilscope.plans import enrich, marts, study
from verification.fixture import CUTOFFS, GROUP_OF_TYPE, Fixture
from verification.modelling import SETUP

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def fixture(spark):
    return Fixture(spark, SMALL)


def test_enrichment_keeps_every_event(fixture):
    assert fixture.enriched.count() == fixture.staged.count() == fixture.table("lineitem").count()
    assert len(fixture.enriched.columns) == 39 and len(fixture.staged.columns) == 28


def test_missing_price_gives_null_components_and_zero_totals(fixture):
    late = fixture.enriched.filter("event_year = 2001")
    assert late.filter("cpi_deflator is not null or property_damage_2024_usd is not null").isEmpty()
    assert late.filter("total_damage_2024_usd <> 0 or total_damage_2024_usd is null").isEmpty()


def test_mart_invariants(fixture):
    impact = marts.economic_impact(fixture.enriched, CUTOFFS)
    assert impact.agg(F.sum("pct_of_total_damage")).first()[0] == pytest.approx(100, abs=0.06)
    risk = marts.geographic_risk(fixture.enriched, CUTOFFS)
    assert risk.filter("not damage_percentile_in_decade between 0 and 100").isEmpty()
    surprise = marts.surprise_states(risk)
    wrong = surprise.filter("is_surprise_state <> (damage_percentile_in_decade - prior_decade_damage_percentile > 20)")
    assert wrong.isEmpty() and surprise.filter("decade = 1990").isEmpty()


def test_surprise_edges(spark):
    rows = [
        ("a", "W", 1990, 5, 100.0, 1, 10.0), ("a", "W", 2010, 6, 300.0, 1, 30.0), ("a", "W", 2020, 6, 300.0, 1, 50.1),
        ("b", None, 1990, 5, 0.0, 1, 0.0), ("b", None, 2000, 5, 50.0, 0, 90.0), ("c", "W", 2000, 1, 1.0, 0, 1.0),
    ]
    names = "state string, region string, decade bigint, event_count bigint, total_damage_2024_usd double, total_deaths_direct bigint, damage_percentile_in_decade double"
    found = {(r.state, r.decade): r for r in marts.surprise_states(spark.createDataFrame(rows, names)).collect()}
    assert set(found) == {("a", 2010), ("a", 2020), ("b", 2000)}
    assert not found["a", 2010].is_surprise_state and found["a", 2010].percentile_rank_change == 20.0
    assert found["a", 2020].is_surprise_state and found["a", 2010].damage_pct_change == 200.0
    assert found["b", 2000].damage_pct_change is None and found["b", 2000].damage_delta_2024_usd == 50.0


def test_unused_lookups_leave_the_plan(fixture):
    plan = marts.economic_impact(fixture.enriched, CUTOFFS)._jdf.queryExecution().optimizedPlan().toString()
    # Region and population are not read: of the four lookups only group (inner after its filter) and price remain.
    assert plan.count("LeftOuter") == 1


def test_quality_suite(fixture):
    models_ = {
        "stg_storm_events": fixture.staged,
        "stg_cpi_deflator": fixture.cpi,
        "mart_severity_trends": marts.severity_trends(fixture.enriched, CUTOFFS),
        "mart_geographic_risk": marts.geographic_risk(fixture.enriched, CUTOFFS),
        "mart_economic_impact": marts.economic_impact(fixture.enriched, CUTOFFS),
    }
    models_["mart_surprise_states"] = marts.surprise_states(models_["mart_geographic_risk"])
    checks = quality.declared_checks(CUTOFFS, list(GROUP_OF_TYPE))
    assert len(checks) == 24
    rows = quality.run_suite(models_, checks).collect()
    failed = {(r.model, r.column_name, r.test) for r in rows if not r.passed}
    assert len(rows) == 24
    assert failed == {("stg_storm_events", "event_id", "unique"), ("stg_storm_events", "event_type_raw", "accepted_values")}


@pytest.fixture(scope="module")
def weighted(fixture):
    return study.weighted_model(fixture.enriched, SETUP)


def test_boosted_model_beats_the_base_rate(weighted):
    model, _, test, _ = weighted
    scored = models.with_score(model, test, "p")
    found = metrics.areas(metrics.curve(scored, "p", study.LABEL)).first()
    base = test.agg(F.avg(study.LABEL)).first()[0]
    assert found.average_precision > base and found.roc_auc > 0.6


def test_model_and_card_survive_storage(spark, weighted, scratch):
    model, _, test, names = weighted
    models.save_model([model], f"{scratch}/model")
    again = models.load_model(f"{scratch}/model")
    a = models.with_score(model, test, "p").agg(F.sum("p")).first()[0]
    b = models.with_score(again, test, "p").agg(F.sum("p")).first()[0]
    assert a == pytest.approx(b, rel=1e-12)
    models.write_card(spark, {"model": "gbt", "threshold": 0.97, "features": len(names)}, f"{scratch}/card")
    assert spark.read.json(f"{scratch}/card").first().asDict() == {"model": "gbt", "threshold": 0.97, "features": len(names)}


def test_scaling_is_saved_with_a_logistic_model(spark, scratch):
    rows = [(float(n % 2), float(n % 13) * 100 + (n % 2) * 300, float(n % 7)) for n in range(200)]
    frame = spark.createDataFrame(rows, "y double, a double, b double")
    names = ["a", "b"]
    scaling = fit_scaling(frame, ["a"])
    model = models.fit_logistic(ft.assemble(scale(frame, scaling), names), "y")
    models.save_model([models.scoring_pipeline(model, names, scaling)], f"{scratch}/model")
    again = models.risk_scores(frame, models.load_model(f"{scratch}/model"), threshold=0.5, name="lr")
    direct = models.with_score(model, ft.assemble(scale(frame, scaling), names), "p")
    want = sorted(round(r["p"], 4) for r in direct.collect())
    assert sorted(r["fatality_risk"] for r in again.collect()) == pytest.approx(want)
    assert again.columns == ["y", "a", "b", "fatality_risk", "is_high_risk", "model", "threshold"]


def test_permutation_importance_does_not_depend_on_the_session(spark):
    rows = [(float(n % 3 == 0), float((n * 7) % 11 + (n % 3 == 0) * 4), float(n % 5)) for n in range(400)]
    frame = spark.createDataFrame(rows, "y double, a double, b double")
    found = []
    for parts in (3, 7):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        score = lambda df: df.withColumn("p", F.col("a") / 20 + F.col("b") / 1000)
        found.append(sorted(tuple(r) for r in explain.permutation_importance(frame.repartition(parts), ["a", "b"], "y", score).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(found[0]) == 2 and [r[0] for r in found[0]] == [r[0] for r in found[1]]
    for left, right in zip(*found):  # sums of areas may differ in the last bit
        assert left[1:] == pytest.approx(right[1:], rel=1e-12)


def test_risk_scores_take_unknown_categories(spark, weighted):
    model, _, _, names = weighted
    raw = spark.createDataFrame([("VOLCANO", "MARS", 2000, 7), ("HURRICANE", "ASIA", 2000, 7)], "event_type_group string, region string, decade int, event_month int")
    hot = ft.one_hot(ft.one_hot(raw, "event_type_group", SETUP.groups), "region", SETUP.regions)
    ready = ft.assemble(ft.align(hot, names, keep=["event_type_group"]), names)
    rows = {r.event_type_group: r for r in models.risk_scores(ready, model, threshold=0.5).collect()}
    assert set(rows) == {"VOLCANO", "HURRICANE"}
    assert all(0 <= r.fatality_risk <= 1 and r.is_high_risk == (r.fatality_risk >= 0.5) for r in rows.values())


def test_permutation_importance_finds_the_only_signal(spark):
    frame = spark.range(2000).select(
        (F.col("id") % 10 == 0).cast("double").alias("y"),
        (F.col("id") % 10 == 0).cast("double").alias("signal"),
        F.pmod(F.xxhash64("id"), F.lit(5)).cast("double").alias("noise"),
    )
    found = explain.permutation_importance(
        frame, ["signal", "noise"], "y", lambda df: df.withColumn("p", F.col("signal") * 0.9 + 0.05)
    )
    importance = {r.feature: r.importance for r in found.collect()}
    assert importance["noise"] == pytest.approx(0) and importance["signal"] > 0.5


def test_weights_follow_their_formulas(spark):
    frame = spark.createDataFrame(
        [("A", 1.0)] * 3 + [("A", 0.0)] * 3 + [("B", 1.0)] + [("B", 0.0)] * 9 + [(None, 1.0)], "g string, y double"
    )
    found = {(r.g, r.y): r for r in ft.danger_weights(frame, "g", "y").distinct().collect()}
    p = 5 / 17
    assert found["B", 1.0].weight == pytest.approx((1 - p) / p * (1 + 4 * 0 / 0.9))
    assert found[None, 1.0].weight == pytest.approx((1 - p) / p)
    assert found["A", 0.0].weight == 1.0
    balanced = {r.y: r.weight for r in ft.balanced_weights(frame, "y").select("y", "weight").distinct().collect()}
    assert balanced == pytest.approx({1.0: 17 / (2 * 5), 0.0: 17 / (2 * 12)})


def test_two_stage_model(fixture):
    frame = study.tier_frame(fixture.enriched, SETUP, 1996, 2000)
    stages, test = study.two_stage_model(frame, study.Setup(CUTOFFS, 1999, SETUP.groups, SETUP.regions, rounds=3))
    applied = stages.apply(test)
    assert applied.filter("flagged and p2 is null or not flagged and p2 is not null").isEmpty()
    assert applied.filter("called and not flagged").isEmpty()
    assert applied.count() == test.count()


def test_modelling_base_excludes_what_it_should(fixture):
    base = enrich.modelling_events(fixture.enriched, CUTOFFS)
    assert base.filter("event_year < 1996 or event_year >= 2001 or region is null or event_type_group is null").isEmpty()


def test_fan_out_after_the_population_join_is_found(fixture):
    """A county that is in the population twice multiplies its events where the lookup isn't reduced to a row per key."""
    staged = fixture.staged.dropDuplicates(["event_id"])
    population = fixture.population.unionByName(fixture.population)
    found = {}
    for guard in (True, False):
        enriched = enrich.enrich_events(staged, fixture.groups, fixture.cpi, fixture.regions, population, guard_fanout=guard)
        found[guard] = quality.run_suite({"int_events_enriched": enriched}, quality.fan_out_checks()).first()
    assert (found[True]["failures"], found[True]["passed"]) == (0, True)
    assert found[False]["failures"] > 0 and not found[False]["passed"]
