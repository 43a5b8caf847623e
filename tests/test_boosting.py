"""The learner on counted cells against Spark's own, and the rounds that the studies ask for; every test builds its own rows."""

import pytest
from pyspark.sql import functions as F

from perilscope.operators import boosting, models
from perilscope.operators import features as ft
from perilscope.plans import study
from verification.modelling import SETUP

NAMES = ["a", "b", "c", "d"]


def hashed(k, of):
    return F.pmod(F.xxhash64("id", F.lit(k)), F.lit(of)).cast("double")


@pytest.fixture(scope="module")
def rows(spark):
    made = spark.range(3000).withColumns({"a": hashed(1, 2), "b": hashed(2, 5), "c": hashed(3, 30), "d": hashed(4, 9), "noise": hashed(5, 5)})
    score = F.col("a") * 2 + F.col("b") * F.col("d") / 6 + F.sin("c") * 2 + F.col("noise")
    made = made.withColumns({"y": (score > 6).cast("double"), "tier": F.when(score > 8, 2.0).when(score > 4, 1.0).otherwise(0.0)})
    return ft.assemble(made.withColumn("w", 1 + 2.5 * F.col("y")), NAMES).drop("id", "noise", *NAMES).cache()


def furthest(df, one, other):
    both = models.with_score(other, models.with_score(one, df, "_p"), "_q")
    return both.agg(F.max(F.abs(F.col("_p") - F.col("_q")))).first()[0]


def test_same_trees_as_spark(spark, rows):
    learner = models.boosted("y", "w", 4, 3, 0.1, 42).setSubsamplingRate(1.0)
    theirs, ours = learner.fit(rows), boosting.fit(rows, learner, [1.0], "w")[0]
    assert furthest(rows, theirs, ours) < 1e-12
    assert ours.treeWeights == theirs.treeWeights and ours.numFeatures == 4
    assert abs(ours.featureImportances.toArray() - theirs.featureImportances.toArray()).max() < 1e-9
    roots = [models.tree_nodes(spark, m).filter("id = 0").orderBy("tree").drop("left", "right", "gain").collect() for m in (theirs, ours)]
    assert [r[:2] + r[2:4] for r in roots[0]] == [r[:2] + r[2:4] for r in roots[1]]


def test_draws_follow_the_cells_not_the_layout(rows):
    one, other = (models.fit_boosted(df, "y", "w", rounds=3, depth=3, counted=True) for df in (rows, rows.repartition(5).sortWithinPartitions("w")))
    whole = boosting.fit(rows, models.boosted("y", "w", 3, 3, 0.1, 42).setSubsamplingRate(1.0), [1.0], "w")[0]
    assert furthest(rows, one, other) < 1e-12
    assert furthest(rows, one, whole) > 1e-3


def test_copies_are_rows_for_every_learner(rows):
    merged = rows.groupBy("features", "y", "w").agg(F.count(F.lit(1)).alias("n"))
    assert merged.count() < rows.count()
    assert furthest(rows, models.fit_boosted(rows, "y", "w", 3, 3, counted=True), models.fit_boosted(merged, "y", "w", 3, 3, copies="n")) < 1e-12
    assert furthest(rows, models.fit_logistic(rows, "y", "w"), models.fit_logistic(merged, "y", "w", copies="n")) < 1e-4
    held = [models.fit_calibration(df.withColumn("s", F.hash("features") % 7 / 7), "s", "y", n) for df, n in ((rows, None), (merged, "n"))]
    assert list(held[0].predictions) == pytest.approx(list(held[1].predictions))


@pytest.mark.parametrize("most", [0, boosting.SORTED])
def test_many_values_are_cut_by_weight(spark, monkeypatch, most):
    monkeypatch.setattr(boosting, "SORTED", most)
    found = spark.range(1000).select(F.array(F.col("id").cast("double"), F.lit(1.0)).alias("x"), F.lit(1.0).alias("w"), F.lit(1).alias("n"))
    cuts, constant = boosting.split_points(found)
    assert len(cuts) == boosting.BINS - 1 and max(abs(cuts - [1000 / 32 * k for k in range(1, 32)])) <= 1 and len(constant) == 0


def test_labels_and_weights_are_checked(rows):
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        models.fit_boosted(rows.withColumn("y", F.lit(2.0)), "y", rounds=1, counted=True)
    with pytest.raises(Exception, match="weights must not be negative"):
        models.fit_boosted(rows.withColumn("w", F.lit(None).cast("double")), "y", "w", rounds=1, counted=True)


def test_other_fits_stay_with_spark(rows):
    assert furthest(rows, models.boosted("y", "w", 2, 3, 0.1, 42).fit(rows), models.fit_boosted(rows, "y", "w", 2, 3)) == 0


def test_tiers_grow_together(rows):
    model = models.fit_tiers(rows, "tier", "w", rounds=3, depth=3)
    assert [len(m.trees) for m in model.models] == [3, 3, 3]
    native = models.with_class(model, rows, "predicted").select("features", "predicted")
    assert native.exceptAll(model.transform(rows).select("features", "prediction")).count() == 0
    assert native.select("predicted").distinct().count() == 3


def test_severity_models_take_all_their_rounds(spark, monkeypatch):
    made = spark.range(400).withColumns({n: hashed(k, 4) for k, n in enumerate(SETUP.feature_names(study.TIER_NUMERIC))})
    made = made.withColumns({
        "event_year": F.lit(1997) + F.col("id") % 4, "event_id": F.col("id"), "event_month": F.lit(5), "event_type_group": F.lit("HAIL"),
        "damage_class": F.col("id") % 4 * 1.0, "fatality_tier": F.element_at(F.array(*map(F.lit, ("NONE", "MINOR", "MASS"))), (F.col("id") % 3 + 1).cast("int")),
    })
    asked = []

    def short(fit):
        def run(*args, rounds, **more):
            asked.append(rounds)
            return fit(*args, rounds=1, **more)

        return run

    monkeypatch.setattr(models, "fit_tiers", short(models.fit_tiers))
    monkeypatch.setattr(models, "fit_boosted", short(models.fit_boosted))
    study.damage_tier_model(made, SETUP)
    study.two_stage_model(made, SETUP)
    assert asked == [200, 200, 200]
