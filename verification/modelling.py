"""Queries of the feature, model and metric operators and, where it can be stated, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilscope.functions.scalars import damage_tier, fatality_tier
from perilscope.operators import explain, metrics, models, resample, sampling
from perilscope.operators import features as ft
from perilscope.plans import enrich, study
from perilscope.vocab import DAMAGE_TIERS, EVENT_GROUPS
from verification.base_sql import with_parts
from verification.fixture import CUTOFFS, FIXTURE_REGIONS, GROUP_OF_TYPE, Fixture
from verification.relational import query

GROUPS = tuple(sorted(GROUP_OF_TYPE.values()))
SETUP = study.Setup(cutoffs=CUTOFFS, last_train_year=1999, groups=GROUPS, regions=FIXTURE_REGIONS, rounds=5)


def scored(f: Fixture) -> DataFrame:
    """Modelling events with a label and a score that is plain arithmetic on two keys."""
    base = enrich.modelling_events(f.enriched, CUTOFFS)
    mixed = F.col("weather_forecast_office").cast("bigint") * 7919 + F.col("noaa_event_id").cast("bigint") * 31
    return base.withColumn("label", (F.col("deaths_direct") > 0).cast("int")).withColumn(
        "score", (mixed % 1000) / F.lit(1000.0)
    )


# --- features ------------------------------------------------------------------------------------


@query(
    "feature_one_hot",
    with_parts("enr", then="SELECT event_type_group, region, count(*) AS n, " + ", ".join(
        [f"CAST(sum(CASE WHEN event_type_group = '{g}' THEN 1 ELSE 0 END) AS DOUBLE) AS \"event_type_group_{g}\"" for g in GROUPS]
        + [f"CAST(sum(CASE WHEN region = '{r}' THEN 1 ELSE 0 END) AS DOUBLE) AS \"region_{r.replace(' ', '_')}\"" for r in FIXTURE_REGIONS]
    ) + " FROM enr GROUP BY 1, 2"),
)
def feature_one_hot(f: Fixture) -> DataFrame:
    hot = ft.one_hot(ft.one_hot(f.enriched, "event_type_group", GROUPS), "region", FIXTURE_REGIONS)
    names = ft.one_hot_names("event_type_group", GROUPS) + ft.one_hot_names("region", FIXTURE_REGIONS)
    return hot.groupBy("event_type_group", "region").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in names]
    )


@query(
    "feature_aligned_subset",
    with_parts("enr", then="""
SELECT event_type_group, count(*) AS n, CAST(count(*) FILTER (event_type_group = 'TORNADO') AS DOUBLE) AS tornado,
       0.0::DOUBLE AS marine, CAST(sum(decade) AS DOUBLE) AS decades
FROM base_c WHERE event_type_group IN ('TORNADO', 'HURRICANE') GROUP BY 1"""),
)
def feature_aligned_subset(f: Fixture) -> DataFrame:
    base = enrich.modelling_events(f.enriched, CUTOFFS)
    subset = ft.one_hot(base.filter(F.col("event_type_group").isin("TORNADO", "HURRICANE")), "event_type_group", GROUPS)
    names = ["decade", *ft.one_hot_names("event_type_group", EVENT_GROUPS)]
    aligned = ft.align(subset, names, keep=["event_type_group"])
    return aligned.groupBy("event_type_group").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("event_type_group_TORNADO").alias("tornado"),
        F.sum("event_type_group_MARINE").alias("marine"),
        F.sum("decade").alias("decades"),
    )


@query(
    "feature_class_weights",
    with_parts("scored", then="""
SELECT label, count(*) AS n, round((SELECT count(*) FROM scored) / (2.0::DOUBLE * count(*)), 9) AS balanced,
       round(CASE WHEN label = 1 THEN (SELECT count(*) FILTER (label = 0) / CAST(count(*) FILTER (label = 1) AS DOUBLE)
             FROM scored) ELSE 1 END, 9) AS scaled
FROM scored GROUP BY 1"""),
)
def feature_class_weights(f: Fixture) -> DataFrame:
    weighted = ft.positive_weights(ft.balanced_weights(scored(f), "label", "balanced"), "label", "scaled")
    return weighted.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.max("balanced"), 9).alias("balanced"),
        F.round(F.min("scaled"), 9).alias("scaled"),
    )


@query(
    "feature_danger_weights",
    with_parts("scored", more="""
rates AS (SELECT event_type_group, sum(label) / CAST(count(*) AS DOUBLE) AS r FROM scored GROUP BY 1),
lim AS (SELECT min(r) AS lo, max(r) AS hi FROM rates),
tot AS (SELECT sum(label) / CAST(count(*) AS DOUBLE) AS p FROM scored)""", then="""
SELECT s.event_type_group, label, count(*) AS n,
       round(max(CASE WHEN label = 1 THEN (1 - p) / p * (1 + 4 * ((r - lo) / (hi - lo))) ELSE 1 END), 6) AS weight
FROM scored s JOIN rates USING (event_type_group), lim, tot GROUP BY 1, 2"""),
)
def feature_danger_weights(f: Fixture) -> DataFrame:
    weighted = ft.danger_weights(scored(f), "event_type_group", "label")
    return weighted.groupBy("event_type_group", "label").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.max("weight"), 6).alias("weight")
    )


@query(
    "feature_target_encoding",
    with_parts("scored", more="""
train AS (SELECT * FROM scored WHERE event_year <= 1999),
tr AS (SELECT event_type_group, sum(label) / CAST(count(*) AS DOUBLE) AS r FROM train GROUP BY 1),
rr AS (SELECT region, sum(label) / CAST(count(*) AS DOUBLE) AS r FROM train GROUP BY 1),
dr AS (SELECT decade, sum(label) / CAST(count(*) AS DOUBLE) AS r FROM train GROUP BY 1),
tot AS (SELECT sum(label) / CAST(count(*) AS DOUBLE) AS p FROM train)""", then="""
SELECT s.event_type_group, s.region, s.decade, count(*) AS n, round(max(coalesce(tr.r, p)), 9) AS type_rate,
       round(max(coalesce(rr.r, p)), 9) AS region_rate, round(max(coalesce(dr.r, p)), 9) AS decade_rate
FROM scored s LEFT JOIN tr USING (event_type_group) LEFT JOIN rr USING (region) LEFT JOIN dr USING (decade), tot
GROUP BY 1, 2, 3"""),
)
def feature_target_encoding(f: Fixture) -> DataFrame:
    rows = scored(f)
    train, _ = ft.split_by_year(rows, 1999)
    columns = {"event_type_group": "type_rate", "region": "region_rate", "decade": "decade_rate"}
    encoded = ft.target_encode(train, rows, columns, "label")
    return encoded.groupBy("event_type_group", "region", "decade").agg(
        F.count(F.lit(1)).alias("n"), *[F.round(F.max(c), 9).alias(c) for c in columns.values()]
    )


@query(
    "feature_imputed",
    with_parts("enr", then="""
SELECT event_id, event_month, state, magnitude IS NULL AS was_missing,
       coalesce(TRY_CAST(replace(replace(tornado_f_scale, 'EF', ''), 'F', '') AS INTEGER), -1) AS fscale_num,
       month(begin_datetime) AS month_num,
       round(coalesce(population_density, (SELECT median(population_density) FROM enr)), 6) AS population_density,
       CASE WHEN magnitude IS NULL THEN 1 ELSE 0 END AS magnitude_missing, coalesce(magnitude, -1) AS magnitude
FROM enr"""),
)
def feature_imputed(f: Fixture) -> DataFrame:
    filled = ft.impute(f.enriched.withColumn("was_missing", F.col("magnitude").isNull()))
    return filled.select(
        "event_id", "event_month", "state", "was_missing", "fscale_num", "month_num",
        F.round("population_density", 6).alias("population_density"), "magnitude_missing", "magnitude",
    )


@query(
    "feature_class_codes",
    with_parts("enr", then="""
SELECT t AS damage_tier, CASE t WHEN 'CATASTROPHIC' THEN 0 WHEN 'HIGH' THEN 1 WHEN 'LOW' THEN 2 ELSE 3 END::DOUBLE AS code,
       count(*) AS n
FROM (SELECT CASE WHEN total_damage_2024_usd < 10000 THEN 'LOW' WHEN total_damage_2024_usd < 1000000 THEN 'MEDIUM'
                  WHEN total_damage_2024_usd < 100000000 THEN 'HIGH' ELSE 'CATASTROPHIC' END AS t FROM enr) GROUP BY 1, 2"""),
)
def feature_class_codes(f: Fixture) -> DataFrame:
    tier = damage_tier(F.col("total_damage_2024_usd"))
    return f.enriched.groupBy(tier.alias("damage_tier"), ft.encode_class(tier, DAMAGE_TIERS).alias("code")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "feature_temporal_split",
    with_parts("scored", then="""
SELECT CASE WHEN event_year <= 1999 THEN 'train' ELSE 'test' END AS part, label, count(*) AS n, min(event_year) AS first_year,
       max(event_year) AS last_year FROM scored GROUP BY 1, 2"""),
)
def feature_temporal_split(f: Fixture) -> DataFrame:
    train, test = ft.split_by_year(scored(f), 1999)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part", "label").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_year").alias("first_year"), F.max("event_year").alias("last_year")
    )


# --- metrics -------------------------------------------------------------------------------------

CURVE = """
counted AS (
  SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM scored GROUP BY 1
),
c AS (
  SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS positives, sum(neg) OVER () AS negatives
  FROM counted WINDOW w AS (ORDER BY score DESC)
),
curve AS (
  SELECT *, tp / CAST(tp + fp AS DOUBLE) AS prec, tp / CAST(positives AS DOUBLE) AS recall,
         fp / CAST(negatives AS DOUBLE) AS fpr,
         coalesce((tp - pos) / CAST(nullif(tp - pos + fp - neg, 0) AS DOUBLE), 1.0::DOUBLE) AS prec_before
  FROM c
)"""


@query(
    "metric_curve_points",
    with_parts("scored", more=CURVE, then="""
SELECT score, pos, neg, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(prec, 9) AS "precision",
       round(recall, 9) AS recall, round(fpr, 9) AS fpr FROM curve"""),
)
def metric_curve_points(f: Fixture) -> DataFrame:
    points = metrics.curve(scored(f), "score", "label")
    return points.select(
        "score", "pos", "neg", "tp", "fp", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "fpr")]
    )


@query(
    "metric_average_precision",
    with_parts("scored", more=CURVE, then="""
SELECT round(sum(pos / CAST(positives AS DOUBLE) * prec), 9) AS average_precision,
       round(sum(pos / CAST(positives AS DOUBLE) * (prec + prec_before) / 2), 9) AS pr_auc_trapezoid,
       round(sum(neg / CAST(negatives AS DOUBLE) * (2 * tp - pos) / (2.0::DOUBLE * positives)), 9) AS roc_auc FROM curve"""),
)
def metric_average_precision(f: Fixture) -> DataFrame:
    found = metrics.areas(metrics.curve(scored(f), "score", "label"))
    return found.select(*[F.round(c, 9).alias(c) for c in found.columns])


@query(
    "metric_thresholds",
    with_parts("scored", more=CURVE + """,
best AS (SELECT score, 2 * prec * recall / (prec + recall + 1e-9::DOUBLE) AS f1 FROM curve)""", then="""
SELECT coalesce((SELECT min(score) FROM curve WHERE prec >= 0.05), (SELECT min(score) FROM curve)) AS max_recall_threshold,
       (SELECT round(max(recall), 9) FROM curve WHERE prec >= 0.05) AS recall_at_floor,
       (SELECT min(score) FROM best WHERE f1 = (SELECT max(f1) FROM best)) AS max_f1_threshold,
       (SELECT round(max(f1), 9) FROM best) AS max_f1,
       (SELECT max(score) FROM curve WHERE recall >= 0.5) AS recall_threshold,
       (SELECT min(score) FROM curve WHERE prec >= 0.10) AS precision_threshold"""),
)
def metric_thresholds(f: Fixture) -> DataFrame:
    found = metrics.thresholds(metrics.curve(scored(f), "score", "label"))
    return found.withColumns({c: F.round(c, 9) for c in ("recall_at_floor", "max_f1")})


REPORT = """
pred AS (SELECT label, CASE WHEN score >= 0.7 THEN 1 ELSE 0 END AS predicted FROM scored)"""


def predicted(f: Fixture) -> DataFrame:
    return scored(f).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query(
    "metric_class_report",
    with_parts("scored", more=REPORT + """,
k AS (SELECT unnest([0, 1]) AS class),
r AS (SELECT class, count(*) FILTER (label = class) AS support, count(*) FILTER (predicted = class) AS called,
             count(*) FILTER (label = class AND predicted = class) AS hits FROM pred, k GROUP BY 1)""", then="""
SELECT class, support, round(hits / CAST(called AS DOUBLE), 6) AS "precision", round(hits / CAST(support AS DOUBLE), 6) AS recall,
       round(2 * hits / CAST(called + support AS DOUBLE), 6) AS f1,
       round(avg(2 * hits / CAST(called + support AS DOUBLE)) OVER (), 6) AS macro_f1 FROM r"""),
)
def metric_class_report(f: Fixture) -> DataFrame:
    return metrics.report(predicted(f), "label", "predicted")


@query(
    "metric_confusion",
    with_parts("scored", more=REPORT, then="""
SELECT label AS actual, predicted, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY label) AS DOUBLE), 6)
         AS share FROM pred GROUP BY 1, 2"""),
)
def metric_confusion(f: Fixture) -> DataFrame:
    return metrics.confusion(predicted(f), "label", "predicted")


@query(
    "metric_confusion_matrix",
    with_parts("scored", more=REPORT, then="""
SELECT label AS actual, round(count(*) FILTER (predicted = 0) / CAST(count(*) AS DOUBLE), 6) AS predicted_0,
       round(count(*) FILTER (predicted = 1) / CAST(count(*) AS DOUBLE), 6) AS predicted_1 FROM pred GROUP BY 1"""),
)
def metric_confusion_matrix(f: Fixture) -> DataFrame:
    return metrics.confusion_matrix(predicted(f), "label", "predicted", [0, 1])


@query(
    "metric_reliability",
    with_parts("scored", then="""
SELECT CAST(least(greatest(ceil(score * 10) - 1, 0), 9) AS INTEGER) AS bin, count(*) AS n, round(avg(score), 6) AS mean_score,
       round(avg(CAST(label AS DOUBLE)), 6) AS positive_rate FROM scored GROUP BY 1"""),
)
def metric_reliability(f: Fixture) -> DataFrame:
    return metrics.reliability(scored(f), "score", "label")


BLENDED = """
three AS (
  SELECT label, score AS a, 1 - score AS b, deaths_direct / 20.0::DOUBLE AS c FROM scored
),
long AS (
  SELECT 'a' AS model, label, a AS score FROM three UNION ALL SELECT 'b', label, b FROM three
  UNION ALL SELECT 'mixed', label, 0.6::DOUBLE * a + 0.4::DOUBLE * c FROM three
),
counted AS (
  SELECT model, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM long GROUP BY 1, 2
),
c AS (
  SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY model) AS positives,
         sum(neg) OVER (PARTITION BY model) AS negatives
  FROM counted WINDOW w AS (PARTITION BY model ORDER BY score DESC)
),
curve AS (SELECT *, tp / CAST(tp + fp AS DOUBLE) AS prec, tp / CAST(positives AS DOUBLE) AS recall FROM c)"""


@query(
    "metric_model_comparison",
    with_parts("scored", more=BLENDED, then="""
SELECT model, round(sum(pos / CAST(positives AS DOUBLE) * prec), 4) AS pr_auc,
       round(sum(neg / CAST(negatives AS DOUBLE) * (2 * tp - pos) / (2.0::DOUBLE * positives)), 4) AS roc_auc,
       round(coalesce(min(score) FILTER (prec >= 0.05), min(score)), 2) AS best_threshold,
       round(coalesce(max(recall) FILTER (prec >= 0.05), 1), 3) AS recall_at_threshold
FROM curve GROUP BY 1"""),
)
def metric_model_comparison(f: Fixture) -> DataFrame:
    rows = scored(f).select(
        "label", F.col("score").alias("a"), (1 - F.col("score")).alias("b"), (F.col("deaths_direct") / 20.0).alias("c")
    )
    mixed = metrics.blend(rows, {"mixed": {"a": 0.6, "c": 0.4}})
    return metrics.compare(mixed, ["a", "b", "mixed"], "label")


@query(
    "metric_funnel",
    with_parts("scored", more="""
b AS (
  SELECT count(*) AS events, count(*) FILTER (label = 1) AS fatal, count(*) FILTER (score >= 0.6) AS flagged,
         count(*) FILTER (score >= 0.6 AND label = 1) AS caught,
         count(*) FILTER (score >= 0.6 AND deaths_direct > 2) AS critical_flagged,
         count(*) FILTER (score >= 0.6 AND deaths_direct > 2 AND score >= 0.8) AS critical_called FROM scored
),
d AS (SELECT *, round(10000.0::DOUBLE * (fatal / CAST(events AS DOUBLE))) AS true_fatal,
             round(10000.0::DOUBLE * (flagged / CAST(events AS DOUBLE))) AS flagged_for_review FROM b),
e AS (SELECT *, round(true_fatal * (caught / CAST(fatal AS DOUBLE))) AS fatal_surfaced FROM d)""", then="""
SELECT *, flagged_for_review - fatal_surfaced AS false_alarms,
       round(fatal_surfaced * (critical_called / CAST(critical_flagged AS DOUBLE))) AS critical_alerts FROM e"""),
)
def metric_funnel(f: Fixture) -> DataFrame:
    score = F.col("score")
    return metrics.funnel(scored(f), F.col("label") == 1, score >= 0.6, F.col("deaths_direct") > 2, score >= 0.8)


# --- models (no SQL equivalent) ------------------------------------------------------------------


@query("model_logistic_coefficients")
def model_logistic_coefficients(f: Fixture) -> DataFrame:
    frame = study.cut_lineage(study.fatality_frame(f.enriched, SETUP))
    train, _ = ft.split_by_year(frame, SETUP.last_train_year)
    names = SETUP.feature_names()
    scaled, _ = study.standardised(train, train, study.NUMERIC)
    weighted = ft.balanced_weights(scaled, study.LABEL, seen=ft.known(ft.label_summary(train, study.LABEL), now=True))
    model = models.fit_logistic(ft.assemble(weighted, names), study.LABEL, "weight")
    return models.importances(f.spark, model, names, top=15)


@query("model_boosted_importance")
def model_boosted_importance(f: Fixture) -> DataFrame:
    model, _, _, names = study.weighted_model(f.enriched, SETUP)
    return models.importances(f.spark, model, names, top=15)


@query("model_risk_scores")
def model_risk_scores(f: Fixture) -> DataFrame:
    model, _, test, _ = study.weighted_model(f.enriched, SETUP)
    keep = ["event_id", "event_type_group", "region", "features"]
    return models.risk_scores(test.select(*keep), model, threshold=0.5).drop("features")


@query("model_permutation_importance")
def model_permutation_importance(f: Fixture) -> DataFrame:
    model, _, test, names = study.weighted_model(f.enriched, SETUP)
    found = explain.permutation_importance(
        test, names, study.LABEL, lambda df: models.with_score(model, df, "p")
    )
    return found.orderBy(F.desc("importance"), "feature")


@query("model_calibration")
def model_calibration(f: Fixture) -> DataFrame:
    frame = study.cut_lineage(study.fatality_frame(f.enriched, SETUP))
    train, test = ft.split_by_year(frame, SETUP.last_train_year)
    fitting, held_out = study.calibration_slice(ft.danger_weights(train, "event_type_group", study.LABEL))
    names = SETUP.feature_names()
    model = models.fit_boosted(ft.assemble(fitting, names), study.LABEL, "weight", rounds=SETUP.rounds)
    raw = models.with_score(model, ft.assemble(held_out, names), "raw")
    calibration = models.fit_calibration(raw, "raw", study.LABEL)
    judged = models.with_score(model, ft.assemble(test, names), "raw")
    judged = models.with_calibrated(calibration, judged, "raw", "calibrated")
    parts = [
        metrics.reliability(judged, score, study.LABEL).withColumn("model", F.lit(score))
        for score in ("raw", "calibrated")
    ]
    return parts[0].unionByName(parts[1])


@query("model_targeted_oversampling")
def model_targeted_oversampling(f: Fixture) -> DataFrame:
    frame = study.fatality_frame(f.enriched, SETUP)
    train, _ = ft.split_by_year(frame, SETUP.last_train_year)
    names = SETUP.feature_names()
    return resample.targeted_smote(
        study.cut_lineage(train), names, study.LABEL, "event_type_group", ("TORNADO", "HURRICANE"), ratio=0.5
    )


@query("model_damage_tiers")
def model_damage_tiers(f: Fixture) -> DataFrame:
    frame = study.tier_frame(f.enriched, SETUP, 1996, 2000)
    judged, _ = study.damage_tier_model(frame, SETUP)
    return metrics.report(study.cut_lineage(judged.select("damage_class", "predicted")), "damage_class", "predicted")


@query("model_two_stage_severity")
def model_two_stage_severity(f: Fixture) -> DataFrame:
    frame = study.tier_frame(f.enriched, SETUP, 1996, 2000)
    stages, test = study.two_stage_model(frame, SETUP)
    return metrics.funnel(
        stages.apply(test),
        F.col("any_death") == 1,
        F.col("flagged"),
        F.col("critical") == 1,
        F.col("called"),
    )


@query("model_study_comparison")
def model_study_comparison(f: Fixture) -> DataFrame:
    return study.compare_models(f.enriched, SETUP, smote_ratio=0.5)


KEY = ("event_id", "event_month", "state", "event_type_group", "region")


@query(
    "sample_test_rows",
    with_parts("scored", more=f"""
picked AS (SELECT event_id, event_month, state, event_type_group, region, CAST(label AS DOUBLE) AS is_fatal,
             md5('42:' || {" || ':' || ".join(f"coalesce({c}, '')" for c in ("event_id", "CAST(month(begin_datetime) AS VARCHAR)", "state", "event_type_group", "region"))}) AS h,
             event_year, month(begin_datetime) AS m FROM scored WHERE event_year > 1999)""", then="""
SELECT event_id, CAST(m AS INTEGER) AS event_month, state, event_type_group, region, is_fatal FROM picked
ORDER BY h, event_id, m, state, event_type_group, region LIMIT 2000"""),
)
def sample_test_rows(f: Fixture) -> DataFrame:
    """Rows of the test years by seeded hash; events that repeat in every key are alike here."""
    frame = study.fatality_frame(f.enriched, SETUP)
    _, test = ft.split_by_year(frame, SETUP.last_train_year)
    return sampling.seeded_sample(test, KEY, 2000).select(*KEY, study.LABEL)


@query(
    "feature_fatality_tier_counts",
    with_parts("enr", then="""
SELECT event_type_group, CASE WHEN deaths_direct = 0 THEN 'NONE' WHEN deaths_direct <= 2 THEN 'MINOR'
       WHEN deaths_direct <= 10 THEN 'SERIOUS' ELSE 'MASS' END AS tier, count(*) AS n FROM base_a GROUP BY 1, 2"""),
)
def feature_fatality_tier_counts(f: Fixture) -> DataFrame:
    base = enrich.grouped_events(f.enriched, CUTOFFS)
    return base.groupBy("event_type_group", fatality_tier(F.col("deaths_direct")).alias("tier")).agg(
        F.count(F.lit(1)).alias("n")
    )
