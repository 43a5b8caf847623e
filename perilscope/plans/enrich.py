"""Enrichment: type group, region, price level and population on every event, and the base filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilscope.functions.scalars import county_key, decade
from perilscope.operators.joins import lookup_join, one_row_per_key
from perilscope.vocab import DEFAULT_CUTOFFS, Cutoffs

ENRICHED_COLUMNS = (
    "event_id", "noaa_event_id", "noaa_episode_id", "event_year", "event_month", "begin_datetime", "end_datetime",
    "state", "state_fips", "county_zone_name", "county_zone_type", "event_type_raw", "event_type_group",
    "weather_forecast_office", "injuries_direct", "injuries_indirect", "deaths_direct", "deaths_indirect",
    "property_damage_usd", "crop_damage_usd", "tornado_f_scale", "tornado_length_miles", "tornado_width_yards",
    "magnitude", "magnitude_type", "hurricane_category", "episode_narrative", "event_narrative",
    "is_pre_standardization", "decade", "region", "property_damage_2024_usd", "crop_damage_2024_usd",
    "total_damage_usd", "total_damage_2024_usd", "cpi_deflator", "cpi_annual_avg", "population_density",
    "population_2020",
)


def attach_groups(events: DataFrame, groups: DataFrame) -> DataFrame:
    """Unknown types keep their row with a NULL group."""
    return lookup_join(events, one_row_per_key(groups, ["event_type_raw"]), ["event_type_raw"])


def attach_prices(events: DataFrame, cpi: DataFrame) -> DataFrame:
    prices = one_row_per_key(cpi.select("cpi_year", "cpi_deflator", "cpi_annual_avg"), ["cpi_year"])
    return lookup_join(events, prices.withColumnRenamed("cpi_year", "event_year"), ["event_year"])


def attach_regions(events: DataFrame, regions: DataFrame) -> DataFrame:
    return lookup_join(events, one_row_per_key(regions, ["state"]), ["state"])


def attach_population(
    events: DataFrame, population: DataFrame, counties_only: bool = False, guard_fanout: bool = True
) -> DataFrame:
    """Match on (state abbreviation, normalised county name).

    Zones are matched by name as well unless ``counties_only``. Without the guard a duplicated
    (state, county) key multiplies events.
    """
    side = population.select(
        F.col("state_abbrev"), F.col("county_name").alias("_county"), "population_density", "population_2020"
    )
    if guard_fanout:
        side = one_row_per_key(side, ["state_abbrev", "_county"], prefer=["population_2020"])
    key = county_key(F.col("county_zone_name"))
    if counties_only:
        key = F.when(F.col("county_zone_type") == "C", key)
    return lookup_join(events.withColumn("_county", key), side, ["state_abbrev", "_county"]).drop("_county")


def real_damage(events: DataFrame) -> DataFrame:
    """Inflation-adjusted amounts. Components keep NULL; totals count a missing component as 0."""
    prop = F.col("property_damage_usd")
    crop = F.col("crop_damage_usd")
    deflator = F.col("cpi_deflator")
    zero = F.lit(0.0)
    return events.withColumns(
        {
            "property_damage_2024_usd": F.round(prop * deflator, 2),
            "crop_damage_2024_usd": F.round(crop * deflator, 2),
            "total_damage_usd": F.round(F.coalesce(prop, zero) + F.coalesce(crop, zero), 2),
            "total_damage_2024_usd": F.round(
                F.coalesce(prop * deflator, zero) + F.coalesce(crop * deflator, zero), 2
            ),
        }
    )


def enrich_events(
    staged: DataFrame,
    groups: DataFrame,
    cpi: DataFrame,
    regions: DataFrame,
    population: DataFrame,
    counties_only: bool = False,
    guard_fanout: bool = True,
) -> DataFrame:
    """All lookups on every staged event: 39 columns, row count unchanged."""
    events = attach_groups(staged, groups)
    events = attach_prices(events, cpi)
    events = attach_regions(events, regions)
    events = attach_population(events, population, counties_only, guard_fanout)
    events = real_damage(events.withColumn("decade", decade(F.col("event_year"))))
    return events.select(*ENRICHED_COLUMNS)


def comparable(events: DataFrame, cutoffs: Cutoffs = DEFAULT_CUTOFFS) -> DataFrame:
    """Comparable, complete years. The flag is a plain comparison on the year, so partitions are pruned."""
    return events.filter((~F.col("is_pre_standardization")) & (F.col("event_year") < cutoffs.partial_year))


def grouped_events(events: DataFrame, cutoffs: Cutoffs = DEFAULT_CUTOFFS) -> DataFrame:
    return comparable(events, cutoffs).filter(F.col("event_type_group").isNotNull())


def located_events(events: DataFrame, cutoffs: Cutoffs = DEFAULT_CUTOFFS) -> DataFrame:
    return comparable(events, cutoffs).filter(F.col("state").isNotNull())


def modelling_events(events: DataFrame, cutoffs: Cutoffs = DEFAULT_CUTOFFS) -> DataFrame:
    return grouped_events(events, cutoffs).filter(F.col("region").isNotNull())
