"""Named reading queries over the marts and the enriched events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilscope.functions.scalars import lookup, safe_ratio, scaled
from perilscope.operators.prefix import exact_quantiles
from perilscope.operators.trend import mark_peak
from perilscope.plans.enrich import modelling_events
from perilscope.plans.marts import yearly_totals
from perilscope.session import cut_lineage
from perilscope.sources.census import STATE_ABBREVIATIONS
from perilscope.vocab import DEFAULT_CUTOFFS, Cutoffs


def events_per_year(severity: DataFrame) -> DataFrame:
    return severity.groupBy("event_year").agg(F.sum("event_count").alias("total_events")).orderBy("event_year")


def damage_per_event_by_year(severity: DataFrame) -> DataFrame:
    """Millions per event and year, with the largest year set apart."""
    years = yearly_totals(severity)
    millions = F.round(safe_ratio(F.col("total_damage"), F.col("total_events")) / 1e6, 3)
    years = years.select("event_year", millions.alias("avg_damage_per_event_millions"))
    return mark_peak(cut_lineage(years), [], "avg_damage_per_event_millions").orderBy("event_year")


def impact_by_type(impact: DataFrame) -> DataFrame:
    return impact.select(
        "event_type_group",
        "total_events",
        scaled(F.col("avg_damage_per_event_2024_usd"), 1e6, 2).alias("avg_damage_millions"),
        scaled(F.col("total_damage_2024_usd"), 1e9, 2).alias("total_damage_billions"),
        "rank_by_damage_per_event",
    ).orderBy("rank_by_damage_per_event")


def damage_by_state_and_decade(
    risk: DataFrame, abbreviations: dict[str, str] = STATE_ABBREVIATIONS, min_decade: int = 1996
) -> DataFrame:
    """Billions per known state and decade with the 95 % value as colour cap. The 1990s decade is below 1996."""
    shown = risk.filter(F.col("decade") >= min_decade).select(
        "state",
        "decade",
        scaled(F.col("total_damage_2024_usd"), 1e9, 2).alias("total_damage_billions"),
        "total_deaths_direct",
        "event_count",
        lookup(F.col("state"), abbreviations).alias("state_abbrev"),
    )
    shown = cut_lineage(shown.filter(F.col("state_abbrev").isNotNull()))
    cap = exact_quantiles(shown, ["total_damage_billions"], [0.95]).select("p0").scalar()
    return shown.withColumn("colour_cap", F.round(cap, 6)).orderBy("decade", "state")


def top_surprise_states(surprise: DataFrame, n: int = 20) -> DataFrame:
    """Largest percentile jumps; ties are settled by state and decade."""
    billions = scaled(F.col("total_damage_2024_usd"), 1e9, 2)
    return (
        surprise.filter("is_surprise_state")
        .select(
            "state",
            "decade",
            "damage_percentile_in_decade",
            "prior_decade_damage_percentile",
            F.round("percentile_rank_change", 1).alias("rank_change"),
            billions.alias("damage_billions"),
            "is_surprise_state",
            F.format_string("%s (%ss)", "state", F.col("decade").cast("string")).alias("label"),
        )
        .orderBy(F.desc("rank_change"), "state", "decade")
        .limit(n)
    )


def exploration_extract(enriched: DataFrame, cutoffs: Cutoffs = DEFAULT_CUTOFFS) -> DataFrame:
    """Typed, grouped and regional events with the month and the fatality label."""
    return modelling_events(enriched, cutoffs).select(
        "event_type_group",
        "state",
        "region",
        "decade",
        "event_year",
        F.month("begin_datetime").alias("event_month"),
        "deaths_direct",
        "injuries_direct",
        "total_damage_2024_usd",
        (F.col("deaths_direct") > 0).cast("int").alias("is_fatal"),
    )


def year_features(severity: DataFrame) -> DataFrame:
    return yearly_totals(severity).select(
        "event_year", "total_events", "avg_damage_per_event", "total_damage", "total_deaths"
    )


def prediction_extract(enriched: DataFrame, first_year: int = 1996, last_year: int = 2025) -> DataFrame:
    """Events of a year range with intensity, exposure and both target bases."""
    kept = enriched.filter(F.col("event_year").between(first_year, last_year) & ~F.col("is_pre_standardization"))
    return kept.select(
        "event_id",
        "event_year",
        "event_month",
        "event_type_group",
        "region",
        "state",
        "county_zone_name",
        "decade",
        "tornado_f_scale",
        "magnitude",
        "magnitude_type",
        "hurricane_category",
        "population_density",
        F.coalesce("deaths_direct", F.lit(0)).alias("total_deaths"),
        "total_damage_2024_usd",
    )
