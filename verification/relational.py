"""Queries of the relational operators and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perilscope.functions import scalars as fn
from perilscope.functions.damage import damage_rejects, damage_usd
from perilscope.operators import joins, profile, quality, sampling, windows
from perilscope.plans import enrich, marts, reports
from perilscope.plans.staging import stage_cpi
from perilscope.session import shared_folder
from perilscope.sources import census, events as event_files, warehouse
from perilscope.sources.prices import with_deflator
from verification.base_sql import cents, damage_sql, with_parts
from verification.fixture import CUTOFFS, DEADLY_FROM, GROUP_OF_TYPE, Fixture

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Fixture], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Fixture(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


# --- staging and scalar functions ----------------------------------------------------------------

STAGED = """event_id, noaa_event_id, noaa_episode_id, event_year, event_month, state, county_zone_name, county_zone_type,
 event_type_raw, weather_forecast_office, injuries_direct, deaths_direct, property_damage_usd, crop_damage_usd,
 tornado_f_scale, magnitude, is_pre_standardization"""


@query("staging_events", with_parts("stg", then=f"SELECT {STAGED}, begin_datetime, end_datetime FROM stg"))
def staging_events(f: Fixture) -> DataFrame:
    return f.staged.select(
        *[c.strip() for c in STAGED.split(",")],
        F.col("begin_datetime").cast("timestamp_ntz").alias("begin_datetime"),
        F.col("end_datetime").cast("timestamp_ntz").alias("end_datetime"),
    )


@query(
    "staging_price_deflators",
    f"""WITH idx AS (SELECT CAST(year(l_shipdate) AS BIGINT) AS cpi_year,
  round({cents('l_extendedprice')} / count(*), 3) AS cpi_annual_avg FROM lineitem GROUP BY 1)
SELECT cpi_year, cpi_annual_avg, CAST(2000 AS BIGINT) AS cpi_base_year,
  (SELECT cpi_annual_avg FROM idx WHERE cpi_year = 2000) / cpi_annual_avg AS cpi_deflator FROM idx""",
)
def staging_price_deflators(f: Fixture) -> DataFrame:
    """Yearly mean line price as the index, so the deflators follow from the whole table."""
    mean = fn.safe_ratio(fn.exact_total(F.col("l_extendedprice")), F.count(F.lit(1)))
    yearly = f.table("lineitem").groupBy(F.year("l_shipdate").cast("bigint").alias("year"))
    return stage_cpi(with_deflator(yearly.agg(F.round(mean, 3).alias("cpi_annual_avg")), CUTOFFS))


@query(
    "staging_county_population",
    with_parts("dims", then="SELECT state_abbrev, county_name, state_name, population_2020, land_area_sqmi, "
               "population_density FROM pop"),
)
def staging_county_population(f: Fixture) -> DataFrame:
    return f.population


@query(
    "function_damage_strings",
    with_parts("raw", then=f"""
SELECT damage_property AS damage_text, count(*) AS n,
       {damage_sql('damage_property')} AS amount
FROM raw GROUP BY damage_property"""),
)
def function_damage_strings(f: Fixture) -> DataFrame:
    texts = f.raw.groupBy(F.col("DAMAGE_PROPERTY").alias("damage_text")).agg(F.count(F.lit(1)).alias("n"))
    return texts.withColumn("amount", damage_usd(F.col("damage_text")))


@query(
    "function_damage_rejects",
    with_parts("raw", then=f"""
SELECT 'DAMAGE_PROPERTY' AS column_name, count(*) FILTER (trim(damage_property) <> ''
       AND ({damage_sql('damage_property')}) IS NULL) AS rejected FROM raw
UNION ALL
SELECT 'DAMAGE_CROPS', count(*) FILTER (trim(damage_crops) <> '' AND ({damage_sql('damage_crops')}) IS NULL) FROM raw"""),
)
def function_damage_rejects(f: Fixture) -> DataFrame:
    return damage_rejects(f.raw, "DAMAGE_PROPERTY", "DAMAGE_CROPS")


@query(
    "function_event_timestamps",
    "SELECT year(l_shipdate) AS ship_year, month(l_shipdate) AS ship_month, count(*) AS n, "
    "CAST(0 AS BIGINT) AS wrong FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2",
)
def function_event_timestamps(f: Fixture) -> DataFrame:
    dated = f.table("lineitem").join(f.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    text = F.upper(F.date_format("l_shipdate", "d-MMM-yy HH:mm:ss"))
    parsed = fn.event_timestamp(text).cast("timestamp_ntz")
    wrong = F.count_if(~parsed.eqNullSafe(F.col("l_shipdate")))
    return dated.groupBy(F.year("l_shipdate").alias("ship_year"), F.month("l_shipdate").alias("ship_month")).agg(
        F.count(F.lit(1)).alias("n"), wrong.alias("wrong")
    )


@query(
    "function_months_and_decades",
    with_parts("stg", then="""
SELECT event_month, month(begin_datetime) AS month_of_date, month(begin_datetime) AS month_num,
       CAST(floor(event_year / 10.0) * 10 AS BIGINT) AS decade, count(*) AS n FROM stg GROUP BY 1, 2, 3, 4"""),
)
def function_months_and_decades(f: Fixture) -> DataFrame:
    return f.staged.groupBy(
        "event_month",
        F.month("begin_datetime").alias("month_of_date"),
        fn.month_number(F.col("event_month")).alias("month_num"),
        fn.decade(F.col("event_year")).alias("decade"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "function_tiers",
    with_parts("enr", then="""
SELECT CASE WHEN total_damage_2024_usd IS NULL OR total_damage_2024_usd < 10000 THEN 'LOW'
            WHEN total_damage_2024_usd < 1000000 THEN 'MEDIUM' WHEN total_damage_2024_usd < 100000000 THEN 'HIGH'
            ELSE 'CATASTROPHIC' END AS damage_tier,
       CASE WHEN deaths_direct = 0 THEN 'NONE' WHEN deaths_direct <= 2 THEN 'MINOR'
            WHEN deaths_direct <= 10 THEN 'SERIOUS' ELSE 'MASS' END AS fatality_tier, count(*) AS n
FROM enr GROUP BY 1, 2"""),
)
def function_tiers(f: Fixture) -> DataFrame:
    return f.enriched.groupBy(
        fn.damage_tier(F.col("total_damage_2024_usd")).alias("damage_tier"),
        fn.fatality_tier(F.col("deaths_direct")).alias("fatality_tier"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "function_tornado_scale",
    with_parts("stg", then="""
SELECT tornado_f_scale, coalesce(TRY_CAST(replace(replace(tornado_f_scale, 'EF', ''), 'F', '') AS INTEGER), -1)
         AS fscale_num, count(*) AS n FROM stg GROUP BY 1, 2"""),
)
def function_tornado_scale(f: Fixture) -> DataFrame:
    scale = fn.tornado_scale(F.col("tornado_f_scale")).alias("fscale_num")
    return f.staged.groupBy("tornado_f_scale", scale).agg(F.count(F.lit(1)).alias("n"))


@query(
    "function_county_names",
    with_parts("stg", then="""
SELECT lower(regexp_replace(trim(county_zone_name), '\\s+(County|Parish|Borough|Census Area|Municipality)$', ''))
         AS county_key, count(*) AS n FROM stg GROUP BY 1"""),
)
def function_county_names(f: Fixture) -> DataFrame:
    key = fn.county_key(F.col("county_zone_name")).alias("county_key")
    return f.staged.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


# --- filters -------------------------------------------------------------------------------------


@query(
    "filter_bases",
    with_parts("enr", then="""
SELECT 'comparable' AS base, count(*) AS n FROM enr WHERE NOT is_pre_standardization AND event_year < 2001
UNION ALL SELECT 'grouped', count(*) FROM base_a UNION ALL SELECT 'located', count(*) FROM base_b
UNION ALL SELECT 'modelling', count(*) FROM base_c
UNION ALL SELECT 'year range', count(*) FROM enr WHERE event_year BETWEEN 1997 AND 1999"""),
)
def filter_bases(f: Fixture) -> DataFrame:
    comparable = ~F.col("is_pre_standardization") & (F.col("event_year") < CUTOFFS.partial_year)
    grouped = F.col("event_type_group").isNotNull()
    located = F.col("state").isNotNull()
    wanted = {
        "comparable": comparable,
        "grouped": comparable & grouped,
        "located": comparable & located,
        "modelling": comparable & grouped & F.col("region").isNotNull(),
        "year range": F.col("event_year").between(1997, 1999),
    }
    counts = f.enriched.agg(*[F.count_if(condition).alias(name) for name, condition in wanted.items()])
    return counts.unpivot([], list(wanted), "base", "n")


@query(
    "filter_membership",
    with_parts("enr", then="""
SELECT event_type_group IN ('TORNADO', 'HURRICANE') AS is_dangerous, count(*) AS n,
       count(*) FILTER (deaths_direct > 0) AS fatal FROM base_c GROUP BY 1"""),
)
def filter_membership(f: Fixture) -> DataFrame:
    dangerous = F.col("event_type_group").isin("MARINE", "HEAT", "HURRICANE", "TORNADO", "FIRE")
    base = enrich.modelling_events(f.enriched, CUTOFFS)
    return base.groupBy(dangerous.alias("is_dangerous")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("deaths_direct") > 0).alias("fatal")
    )


# --- joins ---------------------------------------------------------------------------------------


@query(
    "join_type_groups",
    with_parts("stg", "dims", then="""
SELECT s.event_type_raw, g.event_type_group, count(*) AS n
FROM stg s LEFT JOIN grp g USING (event_type_raw) GROUP BY 1, 2"""),
)
def join_type_groups(f: Fixture) -> DataFrame:
    joined = enrich.attach_groups(f.staged, f.groups)
    return joined.groupBy("event_type_raw", "event_type_group").agg(F.count(F.lit(1)).alias("n"))


@query(
    "join_price_index",
    with_parts("stg", "dims", then="""
SELECT event_year, cpi_deflator, cpi_annual_avg, count(*) AS n
FROM stg LEFT JOIN cpi ON event_year = cpi_year GROUP BY 1, 2, 3"""),
)
def join_price_index(f: Fixture) -> DataFrame:
    joined = enrich.attach_prices(f.staged, f.cpi)
    return joined.groupBy("event_year", "cpi_deflator", "cpi_annual_avg").agg(F.count(F.lit(1)).alias("n"))


@query(
    "join_regions",
    with_parts("stg", "dims", then="""
SELECT s.state, r.state_abbrev, r.region, count(*) AS n FROM stg s LEFT JOIN reg r ON s.state = r.state GROUP BY 1, 2, 3"""),
)
def join_regions(f: Fixture) -> DataFrame:
    joined = enrich.attach_regions(f.staged, f.regions)
    return joined.groupBy("state", "state_abbrev", "region").agg(F.count(F.lit(1)).alias("n"))


@query(
    "join_enriched_events",
    with_parts("enr", then="""
SELECT event_id, event_year, state, region, decade, event_type_group, property_damage_2024_usd, crop_damage_2024_usd,
       total_damage_usd, total_damage_2024_usd, cpi_deflator, population_density, population_2020 FROM enr"""),
)
def join_enriched_events(f: Fixture) -> DataFrame:
    return f.enriched.select(
        "event_id", "event_year", "state", "region", "decade", "event_type_group", "property_damage_2024_usd",
        "crop_damage_2024_usd", "total_damage_usd", "total_damage_2024_usd", "cpi_deflator", "population_density",
        "population_2020",
    )


@query(
    "join_population_fanout",
    with_parts("enr", then="""
SELECT (SELECT count(*) FROM stg) AS events, (SELECT count(*) FROM enr) AS guarded,
       (SELECT count(*) FROM enr e LEFT JOIN pop p ON 'N' || replace(e.state, 'Nation ', '') = p.state_abbrev
          AND e.region IS NOT NULL AND lower(replace(trim(e.county_zone_name), ' County', '')) = p.county_name)
         AS unguarded,
       (SELECT count(*) FROM enr WHERE population_2020 IS NOT NULL AND county_zone_type = 'C') AS county_matches"""),
)
def join_population_fanout(f: Fixture) -> DataFrame:
    placed = enrich.attach_regions(f.staged, f.regions)
    one = F.count(F.lit(1))
    guarded = enrich.attach_population(placed, f.population)
    unguarded = enrich.attach_population(placed, f.population, guard_fanout=False)
    counties = enrich.attach_population(placed, f.population, counties_only=True)
    matched = counties.agg(F.count("population_2020").alias("n"))
    return f.staged.agg(one.alias("events")).select(
        "events",
        guarded.agg(one).scalar().alias("guarded"),
        unguarded.agg(one).scalar().alias("unguarded"),
        matched.scalar().alias("county_matches"),
    )


GAZ = """
gaz AS (
  SELECT 'N' || n_nationkey AS state_abbrev, lower(c_mktsegment) AS county_name,
         CAST(n_nationkey + 10 AS DOUBLE) AS land_area_sqmi
  FROM (SELECT DISTINCT c_mktsegment FROM customer), nation WHERE n_nationkey < 22
),
people AS (
  SELECT 'N' || c_nationkey AS state_abbrev, lower(c_mktsegment) AS county_name, 'NATION_' || c_nationkey AS state_name,
         count(*) AS population_2020 FROM customer GROUP BY 1, 2, 3
)"""


def _county_sources(f: Fixture) -> tuple[DataFrame, DataFrame]:
    customer, nation = f.table("customer"), f.table("nation")
    abbreviations = {f"NATION_{i}": f"N{i}" for i in range(25)}
    counted = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name", "c_mktsegment")
    people = counted.agg(F.count(F.lit(1)).alias("population_2020")).select(
        F.col("n_name").alias("state_name"),
        F.concat("c_mktsegment", F.lit(" County")).alias("county_raw"),
        "population_2020",
    )
    areas = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).filter(F.col("n_nationkey") < 22)
    areas = areas.select("n_nationkey", "c_mktsegment").distinct()
    gazetteer = areas.select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("state_abbrev"),
        F.concat("c_mktsegment", F.lit(" Parish")).alias("county_raw"),
        (F.col("n_nationkey") + 10).cast("double").alias("land_area_sqmi"),
    )
    return census.population_counties(people, abbreviations), census.gazetteer_counties(gazetteer)


@query(
    "join_county_density",
    f"WITH {GAZ.strip()} SELECT state_abbrev, county_name, state_name, population_2020, land_area_sqmi, "
    "round(population_2020 / land_area_sqmi, 4) AS population_density FROM people JOIN gaz USING (state_abbrev, county_name)",
)
def join_county_density(f: Fixture) -> DataFrame:
    return census.county_density(*_county_sources(f))


@query(
    "join_match_rate",
    f"WITH {GAZ.strip()} SELECT count(*) AS rows, count(g.county_name) AS matched, "
    "round(count(g.county_name) / CAST(count(*) AS DOUBLE), 6) AS match_rate, "
    "round(count(g.county_name) / CAST(count(*) AS DOUBLE), 6) >= 0.9 AS ok "
    "FROM people p LEFT JOIN gaz g USING (state_abbrev, county_name)",
)
def join_match_rate(f: Fixture) -> DataFrame:
    return census.density_match(*_county_sources(f))


@query(
    "join_state_year_lags",
    with_parts("sy", then="""
SELECT e.event_id, e.state, e.event_year, coalesce(lag_event_count, 0) AS lag_event_count,
       coalesce(lag_deaths, 0) AS lag_deaths, coalesce(lag_damage, 0) AS lag_damage
FROM base_c e LEFT JOIN lags l ON e.state = l.state AND e.event_year = l.event_year"""),
)
def join_state_year_lags(f: Fixture) -> DataFrame:
    from perilscope.operators.features import attach_lags

    enriched = f.enriched
    lags = marts.state_year_lags(marts.state_year_totals(enriched, CUTOFFS))
    return attach_lags(enrich.modelling_events(enriched, CUTOFFS), lags).select(
        "event_id", "state", "event_year", "lag_event_count", "lag_deaths", "lag_damage"
    )


@query(
    "join_literal_lookup",
    with_parts("raw", then="""
SELECT event_type_raw, CASE event_type_raw WHEN 'STANDARD' THEN 40 WHEN 'MEDIUM' THEN 44 WHEN 'LARGE' THEN 46
       WHEN 'SMALL' THEN 50 ELSE 48 END AS threshold, count(*) AS n FROM raw GROUP BY 1, 2"""),
)
def join_literal_lookup(f: Fixture) -> DataFrame:
    found = fn.lookup(F.col("event_type_raw"), DEADLY_FROM, 48)
    return f.staged.groupBy("event_type_raw", found.alias("threshold")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "join_orphan_years",
    with_parts("stg", "dims", then="""
SELECT event_year, count(*) AS n FROM stg WHERE NOT EXISTS (SELECT 1 FROM cpi WHERE cpi_year = event_year) GROUP BY 1"""),
)
def join_orphan_years(f: Fixture) -> DataFrame:
    lost = joins.orphans(f.staged, f.cpi, "event_year", "cpi_year")
    return lost.groupBy("event_year").agg(F.count(F.lit(1)).alias("n"))


# --- marts and windows ---------------------------------------------------------------------------


@query("mart_severity_trends", with_parts("sev", then="SELECT * FROM sev"))
def mart_severity_trends(f: Fixture) -> DataFrame:
    return marts.ordered_for_reading(marts.severity_trends(f.enriched, CUTOFFS), "event_year", "event_type_group")


@query("mart_geographic_risk", with_parts("risk", then="SELECT * EXCLUDE (exact_dominant) FROM risk"))
def mart_geographic_risk(f: Fixture) -> DataFrame:
    risk = marts.geographic_risk(f.enriched, CUTOFFS)
    return marts.ordered_for_reading(risk, "decade", F.desc("total_damage_2024_usd"))


@query(
    "mart_geographic_risk_exact_mode",
    with_parts("risk", then="SELECT state, decade, exact_dominant AS dominant_event_type FROM risk"),
)
def mart_geographic_risk_exact_mode(f: Fixture) -> DataFrame:
    risk = marts.geographic_risk(f.enriched, CUTOFFS, mode="exact")
    return risk.select("state", "decade", "dominant_event_type")


@query("mart_economic_impact", with_parts("impact", then="SELECT * FROM impact"))
def mart_economic_impact(f: Fixture) -> DataFrame:
    return marts.ordered_for_reading(marts.economic_impact(f.enriched, CUTOFFS), "rank_by_damage_per_event")


@query("mart_surprise_states", with_parts("surprise", then="SELECT * FROM surprise"))
def mart_surprise_states(f: Fixture) -> DataFrame:
    surprise = marts.surprise_states(marts.geographic_risk(f.enriched, CUTOFFS))
    return marts.ordered_for_reading(surprise, "decade", F.desc("percentile_rank_change"))


@query(
    "mart_build",
    with_parts("sev", "surprise", "impact", then="""
SELECT 'mart_severity_trends' AS model, count(*) AS n, sum(event_count) AS events FROM sev
UNION ALL SELECT 'mart_geographic_risk', count(*), sum(event_count) FROM risk
UNION ALL SELECT 'mart_economic_impact', count(*), sum(total_events) FROM impact
UNION ALL SELECT 'mart_surprise_states', count(*), sum(event_count) FROM surprise"""),
)
def mart_build(f: Fixture) -> DataFrame:
    """Rows and events of each mart after a full rebuild."""
    built = marts.build_marts(f.enriched, CUTOFFS)
    parts = [
        df.agg(F.count(F.lit(1)).alias("n"), F.sum(df["total_events" if "total_events" in df.columns else "event_count"]).alias("events"))
        .withColumn("model", F.lit(name))
        for name, df in built.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query("aggregate_state_years", with_parts("sy", then="SELECT * FROM sy"))
def aggregate_state_years(f: Fixture) -> DataFrame:
    return marts.state_year_totals(f.enriched, CUTOFFS)


@query("window_state_year_lags", with_parts("sy", then="SELECT * FROM lags"))
def window_state_year_lags(f: Fixture) -> DataFrame:
    return marts.state_year_lags(marts.state_year_totals(f.enriched, CUTOFFS))


@query(
    "aggregate_conditional_counts",
    with_parts("enr", then="SELECT decade, " + ", ".join(
        f"count(*) FILTER (event_type_group = '{g}') AS \"n_{g}\"" for g in sorted(GROUP_OF_TYPE.values())
    ) + " FROM base_b GROUP BY decade"),
)
def aggregate_conditional_counts(f: Fixture) -> DataFrame:
    located = enrich.located_events(f.enriched, CUTOFFS)
    counts = located.groupBy("decade").agg(*marts.group_counts(F.col("event_type_group")))
    return counts.select("decade", *[f"n_{g}" for g in sorted(GROUP_OF_TYPE.values())])


@query(
    "window_share_and_ranks",
    "SELECT o_orderpriority, revenue, round(revenue / CAST(sum(CAST(revenue AS DECIMAL(30,2))) OVER () AS DOUBLE) * 100, 2)"
    " AS share_pct, rank() OVER (ORDER BY revenue DESC) AS revenue_rank FROM (SELECT o_orderpriority, "
    f"{cents('l_extendedprice')} AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)",
)
def window_share_and_ranks(f: Fixture) -> DataFrame:
    sold = f.table("lineitem").join(f.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    revenue = sold.groupBy("o_orderpriority").agg(fn.money(fn.exact_total(F.col("l_extendedprice"))).alias("revenue"))
    shared = windows.share_of_total(revenue, F.col("revenue"), "share_pct")
    return windows.ranks_descending(shared, {"revenue": "revenue_rank"})


# --- consumer queries ----------------------------------------------------------------------------


@query("report_events_per_year", with_parts("years", then="SELECT event_year, total_events FROM years"))
def report_events_per_year(f: Fixture) -> DataFrame:
    return reports.events_per_year(marts.severity_trends(f.enriched, CUTOFFS))


@query(
    "report_damage_per_event",
    with_parts("years", then="""
SELECT event_year, v AS avg_damage_per_event_millions, v = max(v) OVER () AS is_outlier
FROM (SELECT event_year, round(total_damage / total_events / 1e6, 3) AS v FROM years)"""),
)
def report_damage_per_event(f: Fixture) -> DataFrame:
    return reports.damage_per_event_by_year(marts.severity_trends(f.enriched, CUTOFFS))


@query(
    "report_impact_by_type",
    with_parts("impact", then="""
SELECT event_type_group, total_events, round(avg_damage_per_event_2024_usd / 1e6, 2) AS avg_damage_millions,
       round(total_damage_2024_usd / 1e9, 2) AS total_damage_billions, rank_by_damage_per_event FROM impact"""),
)
def report_impact_by_type(f: Fixture) -> DataFrame:
    return reports.impact_by_type(marts.economic_impact(f.enriched, CUTOFFS))


@query(
    "report_damage_by_state_and_decade",
    with_parts("risk", then="""
SELECT state, decade, b AS total_damage_billions, total_deaths_direct, event_count, 'N' || replace(state, 'Nation ', '')
         AS state_abbrev, round(quantile_cont(b, 0.95) OVER (), 6) AS colour_cap
FROM (SELECT *, round(total_damage_2024_usd / 1e9, 2) AS b FROM risk WHERE decade >= 1996)"""),
)
def report_damage_by_state_and_decade(f: Fixture) -> DataFrame:
    names = {f"Nation {i}": f"N{i}" for i in range(25)}
    return reports.damage_by_state_and_decade(marts.geographic_risk(f.enriched, CUTOFFS), names)


@query(
    "report_top_surprise_states",
    with_parts("surprise", then="""
SELECT state, decade, damage_percentile_in_decade, prior_decade_damage_percentile,
       round(percentile_rank_change, 1) AS rank_change, round(total_damage_2024_usd / 1e9, 2) AS damage_billions,
       is_surprise_state, state || ' (' || decade || 's)' AS label
FROM surprise WHERE is_surprise_state ORDER BY rank_change DESC, state, decade LIMIT 20"""),
)
def report_top_surprise_states(f: Fixture) -> DataFrame:
    return reports.top_surprise_states(marts.surprise_states(marts.geographic_risk(f.enriched, CUTOFFS)))


@query(
    "report_exploration_extract",
    with_parts("enr", then="""
SELECT event_type_group, state, region, decade, event_year, month(begin_datetime) AS event_month, deaths_direct,
       injuries_direct, total_damage_2024_usd, CASE WHEN deaths_direct > 0 THEN 1 ELSE 0 END AS is_fatal FROM base_c"""),
)
def report_exploration_extract(f: Fixture) -> DataFrame:
    return reports.exploration_extract(f.enriched, CUTOFFS)


@query("report_year_features", with_parts("years", then="SELECT * FROM years"))
def report_year_features(f: Fixture) -> DataFrame:
    return reports.year_features(marts.severity_trends(f.enriched, CUTOFFS))


@query(
    "report_prediction_extract",
    with_parts("enr", then="""
SELECT event_id, event_year, event_month, event_type_group, region, state, county_zone_name, decade, tornado_f_scale,
       magnitude, population_density, deaths_direct AS total_deaths, total_damage_2024_usd
FROM enr WHERE event_year BETWEEN 1996 AND 2000 AND NOT is_pre_standardization"""),
)
def report_prediction_extract(f: Fixture) -> DataFrame:
    return reports.prediction_extract(f.enriched, 1996, 2000).drop("magnitude_type", "hurricane_category")


# --- loads, sets, samples ------------------------------------------------------------------------


@query(
    "load_plan_years",
    "SELECT DISTINCT y AS year FROM (SELECT CAST(year(l_shipdate) AS BIGINT) AS y FROM lineitem "
    "WHERE year(l_shipdate) >= 1996 AND year(l_shipdate) NOT IN "
    "(SELECT year(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01') UNION ALL SELECT 1998)",
)
def load_plan_years(f: Fixture) -> DataFrame:
    shipped = f.table("lineitem").select(F.year("l_shipdate").cast("bigint").alias("year")).distinct()
    ordered = f.table("orders").filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    loaded = ordered.select(F.year("o_orderdate").cast("bigint").alias("year")).distinct()
    return event_files.plan_years(shipped, loaded, current_year=1998)


@query("aggregate_distinct_years", "SELECT DISTINCT CAST(year(l_shipdate) AS BIGINT) AS year FROM lineitem")
def aggregate_distinct_years(f: Fixture) -> DataFrame:
    return f.table("lineitem").select(F.year("l_shipdate").cast("bigint").alias("year")).distinct()


def _scratch(f: Fixture, name: str) -> str:
    return f"{shared_folder(f.spark)}/{name}-{uuid.uuid4().hex}"


@query(
    "load_partitioned_table",
    with_parts("raw", then="""
SELECT event_year, state_raw AS state, event_type_raw AS event_type, count(*) AS n, count(damage_property) AS with_damage,
       CAST(sum(deaths_raw) AS BIGINT) AS deaths FROM raw GROUP BY 1, 2, 3"""),
)
def load_partitioned_table(f: Fixture) -> DataFrame:
    """Write the raw table by year, replace one year with itself, read everything back."""
    table = _scratch(f, "raw")
    event_files.write_years(f.raw, table)
    event_files.write_years(f.raw.filter("YEAR = 1999"), table)
    stored = warehouse.read_table(f.spark, table)
    return stored.groupBy(
        F.col("YEAR").alias("event_year"), F.col("STATE").alias("state"), F.col("EVENT_TYPE").alias("event_type")
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("DAMAGE_PROPERTY").alias("with_damage"),
        F.sum("DEATHS_DIRECT").alias("deaths"),
    )


@query(
    "source_event_files",
    with_parts("raw", then="""
SELECT event_year, cz_name, begin_text, count(*) AS n, count(deaths_raw) AS with_deaths,
       CAST(sum(injuries_raw) AS BIGINT) AS injuries FROM raw GROUP BY 1, 2, 3"""),
)
def source_event_files(f: Fixture) -> DataFrame:
    """Write all events as latin-1 gzip CSV and read them with the event reader."""
    folder = _scratch(f, "landed")
    writer = f.raw.write.option("header", True).option("compression", "gzip").option("encoding", "ISO-8859-1")
    writer.option("escape", '"').option("ignoreLeadingWhiteSpace", False).csv(folder)
    read = event_files.read_events(f.spark, folder, glob="*.csv.gz")
    return read.groupBy(
        F.col("YEAR").alias("event_year"), F.col("CZ_NAME").alias("cz_name"), F.col("BEGIN_DATE_TIME").alias("begin_text")
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("DEATHS_DIRECT").alias("with_deaths"),
        F.sum("INJURIES_DIRECT").alias("injuries"),
    )


@query("sample_seeded", "SELECT * FROM events ORDER BY md5('42:' || event_id), event_id LIMIT 500")
def sample_seeded(f: Fixture) -> DataFrame:
    return sampling.seeded_sample(f.table("events"), ["event_id"], 500)


@query("sample_peek", "SELECT * FROM events ORDER BY event_id LIMIT 5")
def sample_peek(f: Fixture) -> DataFrame:
    return sampling.peek(f.table("events"), ["event_id"], 5)


# --- data quality --------------------------------------------------------------------------------

QUALITY = """
SELECT 'stg_storm_events' AS model, 'event_id' AS column_name, 'unique' AS test,
       (SELECT count(*) FROM (SELECT event_id FROM stg GROUP BY 1 HAVING count(*) > 1)) AS failures
UNION ALL SELECT 'stg_storm_events', 'event_id', 'not_null', (SELECT count(*) FROM stg WHERE event_id IS NULL)
UNION ALL SELECT 'stg_storm_events', 'event_year', 'not_null', (SELECT count(*) FROM stg WHERE event_year IS NULL)
UNION ALL SELECT 'stg_storm_events', 'event_year', 'relationships', (SELECT count(*) FROM stg WHERE event_year < 2001
     AND event_year NOT IN (SELECT cpi_year FROM cpi))
UNION ALL SELECT 'stg_storm_events', 'event_type_raw', 'not_null', (SELECT count(*) FROM stg WHERE event_type_raw IS NULL)
UNION ALL SELECT 'stg_storm_events', 'event_type_raw', 'accepted_values', (SELECT count(*) FROM stg
     WHERE event_type_raw NOT IN ('ECONOMY', 'SMALL', 'LARGE', 'MEDIUM', 'STANDARD'))
UNION ALL SELECT 'stg_storm_events', 'deaths_direct', 'not_null', (SELECT count(*) FROM stg WHERE deaths_direct IS NULL)
UNION ALL SELECT 'stg_storm_events', 'is_pre_standardization', 'not_null',
     (SELECT count(*) FROM stg WHERE is_pre_standardization IS NULL)
UNION ALL SELECT 'stg_cpi_deflator', 'cpi_year', 'unique',
     (SELECT count(*) FROM (SELECT cpi_year FROM cpi GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'stg_cpi_deflator', 'cpi_year', 'not_null', (SELECT count(*) FROM cpi WHERE cpi_year IS NULL)
UNION ALL SELECT 'stg_cpi_deflator', 'cpi_deflator', 'not_null', (SELECT count(*) FROM cpi WHERE cpi_deflator IS NULL)
UNION ALL SELECT 'mart_severity_trends', 'event_year', 'not_null', (SELECT count(*) FROM sev WHERE event_year IS NULL)
UNION ALL SELECT 'mart_severity_trends', 'event_type_group', 'not_null',
     (SELECT count(*) FROM sev WHERE event_type_group IS NULL)
UNION ALL SELECT 'mart_severity_trends', 'event_type_group', 'accepted_values', (SELECT count(*) FROM sev
     WHERE event_type_group NOT IN ('TORNADO', 'FLOOD', 'HURRICANE', 'HAIL', 'WIND'))
UNION ALL SELECT 'mart_severity_trends', 'event_count', 'not_null', (SELECT count(*) FROM sev WHERE event_count IS NULL)
UNION ALL SELECT 'mart_geographic_risk', 'state', 'not_null', (SELECT count(*) FROM risk WHERE state IS NULL)
UNION ALL SELECT 'mart_geographic_risk', 'decade', 'not_null', (SELECT count(*) FROM risk WHERE decade IS NULL)
UNION ALL SELECT 'mart_economic_impact', 'event_type_group', 'unique',
     (SELECT count(*) FROM (SELECT event_type_group FROM impact GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'mart_economic_impact', 'event_type_group', 'not_null',
     (SELECT count(*) FROM impact WHERE event_type_group IS NULL)
UNION ALL SELECT 'mart_economic_impact', 'event_type_group', 'accepted_values', (SELECT count(*) FROM impact
     WHERE event_type_group NOT IN ('TORNADO', 'FLOOD', 'HURRICANE', 'HAIL', 'WIND'))
UNION ALL SELECT 'mart_economic_impact', 'avg_damage_per_event_2024_usd', 'not_null',
     (SELECT count(*) FROM impact WHERE avg_damage_per_event_2024_usd IS NULL)
UNION ALL SELECT 'mart_surprise_states', 'state', 'not_null', (SELECT count(*) FROM surprise WHERE state IS NULL)
UNION ALL SELECT 'mart_surprise_states', 'decade', 'not_null', (SELECT count(*) FROM surprise WHERE decade IS NULL)
UNION ALL SELECT 'mart_surprise_states', 'is_surprise_state', 'not_null',
     (SELECT count(*) FROM surprise WHERE is_surprise_state IS NULL)
UNION ALL SELECT 'int_events_enriched', 'event_id', 'unique',
     (SELECT count(*) FROM (SELECT event_id FROM enr GROUP BY 1 HAVING count(*) > 1))"""


@query(
    "quality_suite",
    with_parts("sev", "surprise", "impact", then=f"SELECT *, failures = 0 AS passed FROM ({QUALITY})"),
)
def quality_suite(f: Fixture) -> DataFrame:
    models = {
        "stg_storm_events": f.staged,
        "stg_cpi_deflator": f.cpi,
        **marts.build_marts(f.enriched, CUTOFFS),
        "int_events_enriched": f.enriched,
    }
    return quality.run_suite(models, [*quality.declared_checks(CUTOFFS, list(GROUP_OF_TYPE)), *quality.fan_out_checks()])


@query(
    "quality_duplicate_keys",
    with_parts("stg", then="SELECT event_id, count(*) AS n FROM stg GROUP BY 1 HAVING count(*) > 1"),
)
def quality_duplicate_keys(f: Fixture) -> DataFrame:
    return quality.not_unique(f.staged, "event_id")


# --- profiles ------------------------------------------------------------------------------------


def _rates(key: str) -> str:
    return with_parts("enr", then=f"""
SELECT {key}, count(*) AS total, sum(CASE WHEN deaths_direct > 0 THEN 1 ELSE 0 END) AS flagged,
       round(sum(CASE WHEN deaths_direct > 0 THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE) * 100, 6) AS rate_pct
FROM base_c GROUP BY 1""")


def _rate_query(key: str):
    def build(f: Fixture) -> DataFrame:
        base = enrich.modelling_events(f.enriched, CUTOFFS)
        return profile.rate_by(base, [key], F.col("deaths_direct") > 0).orderBy("rate_pct")

    return build


for _key, _name in (("event_type_group", "type"), ("region", "region"), ("decade", "decade")):
    query(f"profile_fatality_by_{_name}", _rates(_key))(_rate_query(_key))


@query(
    "profile_tier_counts",
    with_parts("enr", then="""
SELECT t.tier AS damage_tier, t.position, coalesce(n, 0) AS n, round(coalesce(n, 0) / CAST((SELECT count(*) FROM enr) AS DOUBLE), 6)
         AS share
FROM (VALUES ('LOW', 0), ('MEDIUM', 1), ('HIGH', 2), ('CATASTROPHIC', 3), ('UNSEEN', 4)) t(tier, position)
LEFT JOIN (SELECT CASE WHEN total_damage_2024_usd < 10000 THEN 'LOW' WHEN total_damage_2024_usd < 1000000 THEN 'MEDIUM'
                       WHEN total_damage_2024_usd < 100000000 THEN 'HIGH' ELSE 'CATASTROPHIC' END AS tier, count(*) AS n
           FROM enr GROUP BY 1) c USING (tier)"""),
)
def profile_tier_counts(f: Fixture) -> DataFrame:
    tiers = f.enriched.select(fn.damage_tier(F.col("total_damage_2024_usd")).alias("damage_tier"))
    return profile.value_counts(tiers, "damage_tier", ["LOW", "MEDIUM", "HIGH", "CATASTROPHIC", "UNSEEN"])


@query(
    "profile_class_counts",
    with_parts("enr", then="""
SELECT deaths_direct > 0 AS is_fatal, count(*) AS n, round(count(*) / CAST((SELECT count(*) FROM base_c) AS DOUBLE), 6)
         AS share FROM base_c GROUP BY 1"""),
)
def profile_class_counts(f: Fixture) -> DataFrame:
    base = enrich.modelling_events(f.enriched, CUTOFFS)
    return profile.value_counts(base.select((F.col("deaths_direct") > 0).alias("is_fatal")), "is_fatal")


MEASURES = ["l_extendedprice", "l_quantity", "l_discount", "l_tax"]


@query(
    "profile_describe",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS \"count\", round(avg({c}), 4) AS mean, "
        f"round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS \"min\", round(quantile_cont({c}, 0.25), 4) AS q25, "
        f"round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75, "
        f"round(max({c}), 4) AS \"max\" FROM lineitem"
        for c in MEASURES
    ),
)
def profile_describe(f: Fixture) -> DataFrame:
    return profile.describe(f.table("lineitem"), MEASURES)


@query(
    "profile_missing_rates",
    with_parts("enr", then=" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(count(*) FILTER ({c} IS NULL) / CAST(count(*) AS DOUBLE), 6) AS missing_rate FROM enr"
        for c in ("population_density", "magnitude", "tornado_f_scale", "region")
    )),
)
def profile_missing_rates(f: Fixture) -> DataFrame:
    return profile.missing_rates(f.enriched, ["population_density", "magnitude", "tornado_f_scale", "region"])


@query(
    "profile_quantiles",
    "SELECT l_returnflag, round(median(l_extendedprice), 6) AS median_price, "
    "round(quantile_cont(l_extendedprice, 0.95), 6) AS p95_price FROM lineitem GROUP BY 1",
)
def profile_quantiles(f: Fixture) -> DataFrame:
    from perilscope.operators.prefix import exact_quantiles

    found = exact_quantiles(f.table("lineitem"), ["l_extendedprice"], [0.5, 0.95], ["l_returnflag"])
    return found.select(
        "l_returnflag", F.round("p0", 6).alias("median_price"), F.round("p1", 6).alias("p95_price")
    )


@query(
    "profile_skewness",
    with_parts("enr", then=" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(skewness({c}), 6) AS skewness, "
        f"round(skewness(CASE WHEN {c} > 0 THEN ln(1 + {c}) END), 6) AS log_skewness FROM base_c"
        for c in ("total_damage_2024_usd", "deaths_direct")
    )),
)
def profile_skewness(f: Fixture) -> DataFrame:
    base = enrich.modelling_events(f.enriched, CUTOFFS)
    return profile.skewness_raw_and_log(base, ["total_damage_2024_usd", "deaths_direct"])


FEATURES_SQL = {
    "log_damage": "ln(1 + total_damage_2024_usd)", "log_deaths": "ln(1 + deaths_direct)",
    "log_injuries": "ln(1 + injuries_direct)", "event_month": "month(begin_datetime)", "decade": "decade",
}


@query(
    "profile_correlations",
    with_parts("enr", then=" UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({x}, {y}), 6) AS r FROM base_c"
        for a, x in FEATURES_SQL.items() for b, y in FEATURES_SQL.items()
    )),
)
def profile_correlations(f: Fixture) -> DataFrame:
    base = enrich.modelling_events(f.enriched, CUTOFFS)
    return profile.correlations(
        base,
        {
            "log_damage": F.log1p("total_damage_2024_usd"),
            "log_deaths": F.log1p("deaths_direct"),
            "log_injuries": F.log1p("injuries_direct"),
            "event_month": F.month("begin_datetime"),
            "decade": F.col("decade"),
        },
    )


@query(
    "profile_histogram",
    "SELECT CAST(least(floor((x - lo) / ((hi - lo) / 50.0::DOUBLE)) + 1, 50) AS INTEGER) AS bin, count(*) AS n FROM "
    "(SELECT l_extendedprice AS x, min(l_extendedprice) OVER () AS lo, max(l_extendedprice) OVER () AS hi FROM lineitem) "
    "GROUP BY 1",
)
def profile_histogram(f: Fixture) -> DataFrame:
    return profile.histogram(f.table("lineitem"), F.col("l_extendedprice"))


@query(
    "profile_class_balance",
    with_parts("enr", then="""
SELECT CASE WHEN event_year <= 1999 THEN 'train' ELSE 'test' END AS split,
       CASE WHEN deaths_direct > 0 THEN 1 ELSE 0 END AS label, count(*) AS n FROM base_c GROUP BY 1, 2"""),
)
def profile_class_balance(f: Fixture) -> DataFrame:
    base = enrich.modelling_events(f.enriched, CUTOFFS)
    split = F.when(F.col("event_year") <= 1999, "train").otherwise("test")
    return profile.class_balance(base, split, (F.col("deaths_direct") > 0).cast("int"))
