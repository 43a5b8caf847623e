"""Staging: one typed projection per source, no joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilscope.functions.damage import damage_usd
from perilscope.functions.scalars import event_key, event_timestamp
from perilscope.vocab import DEFAULT_CUTOFFS, Cutoffs


def stage_events(raw: DataFrame, cutoffs: Cutoffs = DEFAULT_CUTOFFS, strict: bool = False) -> DataFrame:
    """Raw events as 28 typed snake_case columns. NULL damage stays NULL; NULL casualties become 0."""
    c = F.col

    def number(name: str):
        return c(name).cast("double") if strict else c(name).try_cast("double")

    def people(name: str):
        return F.coalesce(c(name), F.lit(0).cast("bigint"))

    return raw.select(
        event_key(c("EVENT_ID"), c("YEAR")).alias("event_id"),
        c("EVENT_ID").cast("string").alias("noaa_event_id"),
        c("EPISODE_ID").cast("string").alias("noaa_episode_id"),
        c("YEAR").cast("bigint").alias("event_year"),
        c("MONTH_NAME").alias("event_month"),
        event_timestamp(c("BEGIN_DATE_TIME"), strict).alias("begin_datetime"),
        event_timestamp(c("END_DATE_TIME"), strict).alias("end_datetime"),
        F.initcap(c("STATE")).alias("state"),
        c("STATE_FIPS").alias("state_fips"),
        c("CZ_NAME").alias("county_zone_name"),
        c("CZ_TYPE").alias("county_zone_type"),
        c("EVENT_TYPE").alias("event_type_raw"),
        c("WFO").alias("weather_forecast_office"),
        people("INJURIES_DIRECT").alias("injuries_direct"),
        people("INJURIES_INDIRECT").alias("injuries_indirect"),
        people("DEATHS_DIRECT").alias("deaths_direct"),
        people("DEATHS_INDIRECT").alias("deaths_indirect"),
        damage_usd(c("DAMAGE_PROPERTY"), strict).alias("property_damage_usd"),
        damage_usd(c("DAMAGE_CROPS"), strict).alias("crop_damage_usd"),
        c("TOR_F_SCALE").alias("tornado_f_scale"),
        number("TOR_LENGTH").alias("tornado_length_miles"),
        number("TOR_WIDTH").alias("tornado_width_yards"),
        number("MAGNITUDE").alias("magnitude"),
        c("MAGNITUDE_TYPE").alias("magnitude_type"),
        number("CATEGORY").alias("hurricane_category"),
        c("EPISODE_NARRATIVE").alias("episode_narrative"),
        c("EVENT_NARRATIVE").alias("event_narrative"),
        F.coalesce(c("YEAR") < F.lit(cutoffs.min_year), F.lit(False)).alias("is_pre_standardization"),
    )


def stage_cpi(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("year").alias("cpi_year"), "cpi_annual_avg", "cpi_base_year", F.col("deflator").alias("cpi_deflator")
    )


def stage_population(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.upper(F.trim("state_abbrev")).alias("state_abbrev"),
        F.lower(F.trim("county_name")).alias("county_name"),
        F.initcap(F.trim("state_name")).alias("state_name"),
        F.col("population_2020").cast("bigint").alias("population_2020"),
        F.col("land_area_sqmi").cast("double").alias("land_area_sqmi"),
        F.round(F.col("population_density").cast("double"), 4).alias("population_density"),
    )
