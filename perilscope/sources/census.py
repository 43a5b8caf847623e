"""County population and land area to population density."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perilscope.functions.scalars import county_key, lookup, safe_ratio
from perilscope.operators.joins import match_rate, one_row_per_key
from perilscope.vocab import COUNTY_SUFFIXES, STATES

KEYS = ["state_abbrev", "county_name"]
STATE_ABBREVIATIONS = {name: abbrev for name, abbrev, _ in STATES}

# County level, all ages, the 2020 estimate.
COUNTY_LEVEL, ALL_AGES, ESTIMATE_2020 = 50, 0, 13


def read_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """Unzipped tab-separated gazetteer with padded headers."""
    raw = spark.read.option("header", True).option("sep", "\t").csv(path)
    named = raw.toDF(*[c.strip() for c in raw.columns])
    return named.select(
        F.trim("USPS").alias("state_abbrev"),
        F.col("NAME").alias("county_raw"),
        F.trim("ALAND_SQMI").try_cast("double").alias("land_area_sqmi"),
    )


def read_population(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("header", True).option("encoding", "ISO-8859-1").option("escape", '"').csv(path)
    level = [F.col(c).try_cast("bigint") for c in ("SUMLEV", "AGEGRP", "YEAR")]
    wanted = (level[0] == COUNTY_LEVEL) & (level[1] == ALL_AGES) & (level[2] == ESTIMATE_2020)
    return raw.filter(wanted).select(
        F.col("STNAME").alias("state_name"),
        F.col("CTYNAME").alias("county_raw"),
        F.col("TOT_POP").try_cast("bigint").alias("population_2020"),
    )


def without_cities(df: DataFrame, name: str = "county_raw") -> DataFrame:
    """Independent cities share names with counties; keep true counties."""
    return df.filter(~F.col(name).endswith(" city"))


def gazetteer_counties(gazetteer: DataFrame) -> DataFrame:
    counties = without_cities(gazetteer)
    return counties.select("state_abbrev", county_key(F.col("county_raw")).alias("county_name"), "land_area_sqmi")


def population_counties(
    population: DataFrame, abbreviations: dict[str, str] = STATE_ABBREVIATIONS, keep_cities: bool = False
) -> DataFrame:
    """``keep_cities`` strips the word from city names instead of dropping them, which duplicates keys."""
    suffixes: Sequence[str] = COUNTY_SUFFIXES
    if keep_cities:
        suffixes = (*COUNTY_SUFFIXES, "city")
    else:
        population = without_cities(population)
    return population.select(
        lookup(F.col("state_name"), abbreviations).alias("state_abbrev"),
        "state_name",
        county_key(F.col("county_raw"), suffixes).alias("county_name"),
        "population_2020",
    )


def county_density(population: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Inner join on (state, county) after reducing the gazetteer to one row per key."""
    area = one_row_per_key(gazetteer.select(*KEYS, "land_area_sqmi"), KEYS)
    density = F.round(safe_ratio(F.col("population_2020"), F.col("land_area_sqmi")), 4)
    return population.join(area, KEYS, "inner").select(
        *KEYS, "state_name", "population_2020", "land_area_sqmi", density.alias("population_density")
    )


def density_match(population: DataFrame, gazetteer: DataFrame, floor: float = 0.9) -> DataFrame:
    return match_rate(population, gazetteer, KEYS, floor)
