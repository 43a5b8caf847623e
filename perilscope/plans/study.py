"""Model studies: fatality risk, danger weighting, oversampling, calibration, two-stage severity, damage tiers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilscope.functions.scalars import damage_tier, exact_total, fatality_tier, hash_fraction, money
from perilscope.operators import features as ft
from perilscope.operators import metrics, models, resample
from perilscope.operators.scaling import Scaling, fit_scaling, scale
from perilscope.plans.enrich import comparable, modelling_events
from perilscope.plans.marts import state_year_lags, state_year_totals
from perilscope.plans.reports import prediction_extract
from perilscope.session import cut_lineage
from perilscope.vocab import (
    DAMAGE_TIERS,
    DANGEROUS_GROUPS,
    DEFAULT_CUTOFFS,
    EVENT_GROUPS,
    FATALITY_TIERS,
    REGIONS,
    Cutoffs,
)

LABEL = "is_fatal"
COPIES = "_copies"
NUMERIC = (*ft.CALENDAR, *ft.LAGS)
RATES = {
    "event_type_group": "type_fatality_rate",
    "region": "region_fatality_rate",
    "decade": "decade_fatality_rate",
}
TIER_NUMERIC = (
    "decade", "month_num", "fscale_num", "magnitude", "magnitude_missing", "population_density", *ft.LAGS,
)
FRAME_INPUTS = (
    "event_id", "state", "event_year", "event_type_group", "region", "decade", "begin_datetime", "deaths_direct", "total_damage_2024_usd",
    "is_pre_standardization",
)


@dataclass(frozen=True)
class Setup:
    """What a study depends on. Defaults follow the full event history."""

    cutoffs: Cutoffs = DEFAULT_CUTOFFS
    last_train_year: int = 2010
    groups: Sequence[str] = EVENT_GROUPS
    regions: Sequence[str] = REGIONS
    rounds: int = 100
    tier_rounds: int = 200

    def feature_names(self, numeric: Sequence[str] = NUMERIC) -> list[str]:
        return ft.feature_names(numeric, self.groups, self.regions)


def fatality_frame(enriched: DataFrame, setup: Setup) -> DataFrame:
    """Labelled events with lag and one-hot features.

    Lags come from all located events, the rows from grouped and regional ones. Both read the few columns that they need from a
    stored table, so the events are enriched once.
    """
    base = cut_lineage(comparable(enriched, setup.cutoffs).select(*FRAME_INPUTS))
    lags = state_year_lags(state_year_totals(base, setup.cutoffs))
    events = modelling_events(base, setup.cutoffs).select(
        "event_id",
        "state",
        "event_year",
        "event_type_group",
        "region",
        "decade",
        F.month("begin_datetime").alias("event_month"),
        ft.fatal_label(F.col("deaths_direct")).alias(LABEL),
    )
    lagged = ft.attach_lags(events, lags)
    return ft.one_hot(ft.one_hot(lagged, "event_type_group", setup.groups), "region", setup.regions)


def standardised(train: DataFrame, df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, Scaling]:
    scaling = fit_scaling(train, columns)
    return scale(df, scaling), scaling


def calibration_slice(df: DataFrame, share: float = 0.2, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """Split training rows by hash into a fitting part and a held-out part for calibration."""
    kept = held_out(share, seed)
    return df.filter(~kept), df.filter(kept)


def held_out(share: float = 0.2, seed: int = 7) -> Column:
    return hash_fraction(F.col("event_id"), F.col("event_month"), F.lit(seed)) < share


def merged(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows equal in these columns as one, stored with the number of its copies."""
    return cut_lineage(df.groupBy(*columns).agg(F.count(F.lit(1)).alias(COPIES)))


def compare_models(enriched: DataFrame, setup: Setup, smote_ratio: float = 0.1) -> DataFrame:
    """Every model of the study on the test years, with blends: areas, chosen cut-off, recall.

    Rows that are equal in label and features weigh the same in a fit and get equal scores: they are merged, fits and curves count their copies.
    """
    names = setup.feature_names()
    frame = cut_lineage(fatality_frame(enriched, setup))
    train, _ = ft.split_by_year(frame, setup.last_train_year)
    seen = ft.known(ft.label_summary(train, LABEL, list(RATES)), now=True)
    encoded = ft.target_encode(train, frame, RATES, LABEL, seen)
    weighted = ft.positive_weights(ft.balanced_weights(encoded, LABEL, "w_balanced", seen), LABEL, "w_positive", seen)
    weighted = ft.danger_weights(weighted, "event_type_group", LABEL, "w_danger", seen)
    train, test = ft.split_by_year(encoded, setup.last_train_year)
    weighted, _ = ft.split_by_year(weighted, setup.last_train_year)
    rates = list(RATES.values())
    shapes = {
        "one_hot": (names, NUMERIC),
        "encoded": ([*NUMERIC, *rates], (*NUMERIC, *rates)),
        "combined": ([*names, *rates], (*NUMERIC, *rates)),
    }
    scored = test.groupBy(LABEL, *names, *rates).agg(F.count(F.lit(1)).alias(COPIES))
    weighted = merged(weighted.withColumn("_held", held_out()), [LABEL, *names, *rates, "w_balanced", "w_positive", "w_danger", "_held"])
    scalings = fit_scaling(train, (*NUMERIC, *rates))
    for shape, (columns, numeric) in shapes.items():
        scaling = {c: scalings[c] for c in numeric}
        linear = models.fit_logistic(
            ft.assemble(scale(weighted, scaling), columns), LABEL, "w_balanced", copies=COPIES
        )
        scored = _append(linear, scored, columns, f"lr_{shape}", scaling)
        boosted = models.fit_boosted(ft.assemble(weighted, columns), LABEL, rounds=setup.rounds, copies=COPIES)
        scored = _append(boosted, scored, columns, f"gb_{shape}")
    variants = {"gb_weighted": "w_danger", "gb_positive_scaled": "w_positive"}
    for name, weight in variants.items():
        model = models.fit_boosted(ft.assemble(weighted, names), LABEL, weight, rounds=setup.rounds, copies=COPIES)
        scored = _append(model, scored, names, name)
    scaling = {c: scalings[c] for c in NUMERIC}
    linear = models.fit_logistic(ft.assemble(scale(weighted, scaling), names), LABEL, "w_danger", copies=COPIES)
    scored = _append(linear, scored, names, "lr_weighted", scaling)
    grown = merged(resample.targeted_smote(train, names, LABEL, "event_type_group", DANGEROUS_GROUPS, smote_ratio), [LABEL, *names])
    model = models.fit_boosted(ft.assemble(grown, names), LABEL, rounds=setup.rounds, copies=COPIES)
    scored = _append(model, scored, names, "gb_smote")
    fitting, kept = weighted.filter(~F.col("_held")), weighted.filter("_held")
    inner = models.fit_boosted(ft.assemble(fitting, names), LABEL, "w_danger", rounds=setup.rounds, copies=COPIES)
    calibration = models.fit_calibration(
        models.with_score(inner, ft.assemble(kept, names), "raw"), "raw", LABEL, COPIES
    )
    scored = _append(inner, scored, names, "gb_inner")
    scored = models.with_calibrated(calibration, scored, "gb_inner", "gb_calibrated").drop("gb_inner")
    blends = {
        "blend_equal": {"gb_weighted": 0.5, "gb_smote": 0.5},
        "blend_60_40": {"gb_weighted": 0.6, "gb_smote": 0.4},
        "blend_three": {m: 1 / 3 for m in ("gb_weighted", "gb_smote", "lr_one_hot")},
        "blend_four": {m: 1 / 4 for m in ("gb_weighted", "gb_smote", "lr_one_hot", "gb_positive_scaled")},
    }
    scored = metrics.blend(scored, blends)
    columns = [c for c in scored.columns if c.startswith(("lr_", "gb_", "blend_"))]
    return metrics.compare(cut_lineage(scored.select(LABEL, COPIES, *columns)), columns, LABEL, copies=COPIES)


def _append(model, df: DataFrame, columns: Sequence[str], out: str, scaling: Scaling | None = None) -> DataFrame:
    """Score with features scaled on the side; the frame keeps its own columns unscaled."""
    if scaling is None:
        return models.with_score(model, ft.assemble(df, columns), out).drop(models.FEATURES)
    side = scale(df, scaling, suffix="__s")
    inputs = [f"{c}__s" if c in scaling else c for c in columns]
    extra = [f"{c}__s" for c in scaling]
    return models.with_score(model, ft.assemble(side, inputs), out).drop(models.FEATURES, *extra)


def weighted_model(enriched: DataFrame, setup: Setup):
    """The selected model: boosted trees with danger weights. Returns (model, train, test, names)."""
    names = setup.feature_names()
    frame = cut_lineage(fatality_frame(enriched, setup))
    train, test = ft.split_by_year(frame, setup.last_train_year)
    train = ft.danger_weights(train, "event_type_group", LABEL)
    model = models.fit_boosted(ft.assemble(train, names), LABEL, "weight", rounds=setup.rounds)
    return model, train, ft.assemble(test, names), names


def tier_frame(enriched: DataFrame, setup: Setup, first_year: int = 1996, last_year: int = 2025) -> DataFrame:
    """Events with imputed intensity and exposure, lags, one-hot columns and both tiers.

    The extract is stored: the median, the lags and the rows, however often a fit scans them, come from events enriched once.
    """
    extract = cut_lineage(prediction_extract(enriched, first_year, last_year))
    totals = extract.filter(F.col("state").isNotNull()).groupBy("state", "event_year")
    totals = totals.agg(
        F.count("event_id").alias("state_year_event_count"),
        F.sum("total_deaths").alias("state_year_deaths"),
        money(exact_total(F.col("total_damage_2024_usd"))).alias("state_year_damage"),
    )
    ready = ft.attach_lags(ft.impute(extract), state_year_lags(totals))
    ready = ft.one_hot(ft.one_hot(ready, "event_type_group", setup.groups), "region", setup.regions)
    return ready.withColumns(
        {
            "damage_tier": damage_tier(F.col("total_damage_2024_usd")),
            "fatality_tier": fatality_tier(F.col("total_deaths")),
            "damage_class": ft.encode_class(damage_tier(F.col("total_damage_2024_usd")), DAMAGE_TIERS),
            "fatality_class": ft.encode_class(fatality_tier(F.col("total_deaths")), FATALITY_TIERS),
        }
    )


def damage_tier_model(frame: DataFrame, setup: Setup):
    """(predictions on the test years, model); balanced class weights."""
    names = setup.feature_names(TIER_NUMERIC)
    train, test = ft.split_by_year(frame, setup.last_train_year)
    weighted = ft.assemble(ft.balanced_weights(train, "damage_class"), names)
    weighted = cut_lineage(weighted.select(models.FEATURES, "damage_class", "weight"))
    model = models.fit_tiers(weighted, "damage_class", "weight", rounds=setup.tier_rounds)
    return models.with_class(model, ft.assemble(test, names), "predicted"), model


def two_stage_model(frame: DataFrame, setup: Setup) -> tuple[models.TwoStage, DataFrame]:
    """Screen for any death, then minor against critical on what the screen flags.

    Both cut-offs are the best F1 on training rows held out from both fits, the second one among flagged rows. Rows
    without deaths that the screen flags count as minor.
    """
    names = setup.feature_names(TIER_NUMERIC)
    staged = frame.withColumns(
        {
            "any_death": (F.col("fatality_tier") != "NONE").cast("double"),
            "critical": F.col("fatality_tier").isin("SERIOUS", "MASS").cast("double"),
        }
    )
    train, test = ft.split_by_year(cut_lineage(ft.assemble(staged, names)), setup.last_train_year)
    fitting, held_out = calibration_slice(train)
    first_train = ft.danger_weights(fitting, "event_type_group", "any_death")
    first = models.fit_boosted(first_train, "any_death", "weight", rounds=setup.tier_rounds, step=0.05, counted=True)
    second_train = ft.balanced_weights(fitting.filter(F.col("any_death") == 1), "critical")
    second = models.fit_boosted(second_train, "critical", "weight", rounds=setup.tier_rounds, step=0.05, counted=True)
    screened = cut_lineage(models.with_score(second, models.with_score(first, held_out, "p1"), "p2"))
    t1 = _best_f1(screened, "p1", "any_death")
    flagged = screened.filter(F.col("p1") >= t1)
    return models.TwoStage(first, second, t1, _best_f1(flagged, "p2", "critical")), test


def _best_f1(df: DataFrame, score: str, label: str) -> float:
    found = metrics.thresholds(metrics.curve(df, score, label)).select("max_f1_threshold").first()
    return 0.5 if found is None or found[0] is None else float(found[0])
