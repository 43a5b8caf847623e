"""Common table expressions for the SQL side: the adapter, staging and enrichment written again as SQL."""

from __future__ import annotations

RAW = """
raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS event_id_raw,
         CAST(l_suppkey AS VARCHAR) AS episode_id,
         CAST(l_partkey AS VARCHAR) AS wfo,
         l_orderkey, l_partkey, l_linenumber, l_shipdate,
         CAST(year(l_shipdate) AS BIGINT) AS event_year,
         monthname(l_shipdate) AS month_name,
         CASE WHEN n_nationkey <> 24 THEN upper(replace(n_name, '_', ' ')) END AS state_raw,
         upper(strftime(l_shipdate, '%d-%b-%y %H:%M:%S')) AS begin_text,
         upper(strftime(l_shipdate, '%d-%b-%y')) || ' 23:59:59' AS end_text,
         p_type AS event_type_raw,
         ' ' || c_mktsegment || ' County' AS cz_name,
         CASE WHEN l_returnflag = 'N' THEN 'Z' ELSE 'C' END AS cz_type,
         CASE WHEN q >= thr THEN q - thr + 1 WHEN l_linenumber = 7 THEN NULL ELSE 0 END AS deaths_raw,
         CASE WHEN l_linenumber <> 7 THEN q % 5 END AS injuries_raw,
         CASE l_linenumber WHEN 1 THEN q || '.00K' WHEN 2 THEN q || '.5m' WHEN 3 THEN q || 'T' WHEN 4 THEN ' '
              WHEN 5 THEN 'K' WHEN 6 THEN CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR)
              WHEN 7 THEN CASE WHEN q = 50 THEN '1.5B' END END AS damage_property,
         CASE WHEN l_discount >= 0.05 THEN q || 'K' ELSE '0' END AS damage_crops,
         CASE WHEN l_returnflag <> 'N' THEN l_extendedprice / 1000 END AS magnitude,
         CASE WHEN p_type = 'MEDIUM' THEN CASE WHEN l_linenumber = 7 THEN 'EFU'
              ELSE (CASE WHEN l_linenumber % 2 = 0 THEN 'EF' ELSE 'F' END) || (l_linenumber % 6) END END AS f_scale,
         CAST(n_nationkey AS VARCHAR) AS state_fips,
         CASE WHEN l_linenumber = 2 THEN q % 3 END AS injuries_beside, CASE WHEN l_linenumber = 3 THEN q % 2 END AS deaths_beside,
         CASE WHEN p_type = 'MEDIUM' THEN (q // 10) || '.5' END AS tor_length,
         CASE WHEN p_type = 'MEDIUM' THEN CASE WHEN l_linenumber = 5 THEN 'wide' ELSE CAST(q AS VARCHAR) END END AS tor_width,
         CASE WHEN l_returnflag = 'A' THEN 'EG' WHEN l_returnflag <> 'N' THEN 'MG' END AS magnitude_type,
         CASE WHEN p_type = 'STANDARD' THEN CAST(l_linenumber % 5 + 1 AS VARCHAR) END AS category,
         'Episode ' || l_suppkey AS episode_narrative,
         CASE WHEN l_linenumber % 2 = 1 THEN 'Event ' || l_orderkey || ', "seen"' END AS event_narrative
  FROM (SELECT *, CAST(floor(l_quantity) AS BIGINT) AS q FROM lineitem) l
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN (SELECT *, CASE p_type WHEN 'STANDARD' THEN 40 WHEN 'MEDIUM' THEN 44 WHEN 'LARGE' THEN 46
                              WHEN 'SMALL' THEN 50 ELSE 48 END AS thr FROM part) p ON l_partkey = p_partkey
)"""


def damage_sql(column: str) -> str:
    """Damage string in dollars; DuckDB gives NULL for unreadable text through TRY_CAST."""
    parts = "".join(
        f" WHEN upper({column}) LIKE '%{s}' THEN TRY_CAST(replace(upper({column}), '{s}', '') AS DOUBLE) * {f}"
        for s, f in (("K", "1e3"), ("T", "1e3"), ("M", "1e6"), ("B", "1e9"))
    )
    return (
        f"CASE WHEN {column} IS NULL OR trim({column}) = '' THEN NULL{parts} ELSE TRY_CAST({column} AS DOUBLE) END"
    )


STG = f"""
stg AS (
  SELECT event_id_raw || '-' || event_year AS event_id, event_id_raw AS noaa_event_id, episode_id AS noaa_episode_id,
         event_year, month_name AS event_month,
         strptime(begin_text, '%d-%b-%y %H:%M:%S') AS begin_datetime,
         strptime(end_text, '%d-%b-%y %H:%M:%S') AS end_datetime,
         replace(state_raw, 'NATION', 'Nation') AS state, cz_name AS county_zone_name, cz_type AS county_zone_type,
         event_type_raw, wfo AS weather_forecast_office,
         coalesce(injuries_raw, 0) AS injuries_direct, coalesce(deaths_raw, 0) AS deaths_direct,
         {damage_sql('damage_property')} AS property_damage_usd,
         {damage_sql('damage_crops')} AS crop_damage_usd,
         f_scale AS tornado_f_scale, magnitude,
         coalesce(event_year < 1996, FALSE) AS is_pre_standardization,
         state_fips, coalesce(injuries_beside, 0) AS injuries_indirect, coalesce(deaths_beside, 0) AS deaths_indirect,
         TRY_CAST(tor_length AS DOUBLE) AS tornado_length_miles, TRY_CAST(tor_width AS DOUBLE) AS tornado_width_yards,
         magnitude_type, TRY_CAST(category AS DOUBLE) AS hurricane_category, episode_narrative, event_narrative
  FROM raw
)"""

DIMS = """
grp(event_type_raw, event_type_group) AS (
  VALUES ('ECONOMY','WIND'), ('SMALL','HAIL'), ('LARGE','FLOOD'), ('MEDIUM','TORNADO'), ('STANDARD','HURRICANE')
),
idx(cpi_year, cpi_annual_avg) AS (
  VALUES (1995, 152.4::DOUBLE), (1996, 156.9::DOUBLE), (1997, 160.5::DOUBLE), (1998, 163.0::DOUBLE),
         (1999, 166.6::DOUBLE), (2000, 172.2::DOUBLE)
),
cpi AS (
  SELECT CAST(cpi_year AS BIGINT) AS cpi_year, cpi_annual_avg, CAST(2000 AS BIGINT) AS cpi_base_year,
         172.2::DOUBLE / cpi_annual_avg AS cpi_deflator
  FROM idx WHERE cpi_year >= 1996 OR cpi_year = 1995
),
reg AS (
  SELECT 'Nation ' || n_nationkey AS state, 'N' || n_nationkey AS state_abbrev, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 23
),
pop AS (
  SELECT 'N' || n_nationkey AS state_abbrev, lower(c_mktsegment) AS county_name, 'Nation ' || n_nationkey AS state_name,
         people AS population_2020, CAST(n_nationkey + 10 AS DOUBLE) AS land_area_sqmi,
         round(people / CAST(n_nationkey + 10 AS DOUBLE), 4) AS population_density
  FROM (SELECT c_nationkey AS n_nationkey, c_mktsegment, count(*) AS people FROM customer GROUP BY 1, 2
        UNION ALL SELECT DISTINCT 0, c_mktsegment, 1 FROM customer
                  WHERE c_nationkey = 0 AND c_mktsegment = 'BUILDING')
),
pop1 AS (
  SELECT state_abbrev, county_name, max(population_2020) AS population_2020,
         arg_max(population_density, population_2020) AS population_density
  FROM pop GROUP BY 1, 2
)"""

ENR = """
enr AS (
  SELECT s.*, g.event_type_group, CAST(floor(s.event_year / 10.0) * 10 AS BIGINT) AS decade, r.region,
         round(property_damage_usd * cpi_deflator, 2) AS property_damage_2024_usd,
         round(crop_damage_usd * cpi_deflator, 2) AS crop_damage_2024_usd,
         round(coalesce(property_damage_usd, 0) + coalesce(crop_damage_usd, 0), 2) AS total_damage_usd,
         round(coalesce(property_damage_usd * cpi_deflator, 0) + coalesce(crop_damage_usd * cpi_deflator, 0), 2)
           AS total_damage_2024_usd,
         c.cpi_deflator, c.cpi_annual_avg, p.population_density, p.population_2020
  FROM stg s
  LEFT JOIN grp g ON s.event_type_raw = g.event_type_raw
  LEFT JOIN cpi c ON s.event_year = c.cpi_year
  LEFT JOIN reg r ON s.state = r.state
  LEFT JOIN pop1 p ON r.state_abbrev = p.state_abbrev
       AND lower(regexp_replace(trim(s.county_zone_name),
                 '\\s+(County|Parish|Borough|Census Area|Municipality)$', '')) = p.county_name
),
base_a AS (SELECT * FROM enr WHERE NOT is_pre_standardization AND event_year < 2001 AND event_type_group IS NOT NULL),
base_b AS (SELECT * FROM enr WHERE NOT is_pre_standardization AND event_year < 2001 AND state IS NOT NULL),
base_c AS (SELECT * FROM base_a WHERE region IS NOT NULL)"""


def cents(expression: str) -> str:
    return f"CAST(sum(CAST({expression} AS DECIMAL(20,2))) AS DOUBLE)"


SEVERITY = f"""
sev AS (
  SELECT event_year, event_type_group, count(*) AS event_count, sum(deaths_direct) AS total_deaths_direct,
         sum(injuries_direct) AS total_injuries_direct, round(avg(deaths_direct), 4) AS avg_deaths_per_event,
         {cents('total_damage_usd')} AS total_damage_usd, {cents('total_damage_2024_usd')} AS total_damage_2024_usd,
         round({cents('total_damage_2024_usd')} / count(*), 2) AS avg_damage_per_event_2024_usd,
         round(sum(deaths_direct) / CAST(count(*) AS DOUBLE), 4) AS fatality_rate_per_event
  FROM base_a GROUP BY 1, 2
)"""

RISK = f"""
risk0 AS (
  SELECT state, region, decade, count(*) AS event_count, sum(deaths_direct) AS total_deaths_direct,
         sum(injuries_direct) AS total_injuries_direct, {cents('total_damage_2024_usd')} AS total_damage_2024_usd,
         {cents('coalesce(property_damage_2024_usd, 0)')} AS property_damage_2024_usd,
         {cents('coalesce(crop_damage_2024_usd, 0)')} AS crop_damage_2024_usd,
         count(*) FILTER (event_type_group = 'TORNADO') AS n_t, count(*) FILTER (event_type_group = 'FLOOD') AS n_f,
         count(*) FILTER (event_type_group = 'WIND') AS n_w, count(*) FILTER (event_type_group = 'HURRICANE') AS n_h,
         count(*) FILTER (event_type_group = 'HAIL') AS n_hail
  FROM base_b GROUP BY 1, 2, 3
),
risk AS (
  SELECT state, region, decade, event_count, total_deaths_direct, total_injuries_direct, total_damage_2024_usd,
         property_damage_2024_usd, crop_damage_2024_usd,
         round(total_damage_2024_usd / event_count, 2) AS avg_damage_per_event_2024_usd,
         CASE WHEN n_t >= n_f AND n_t >= n_h AND n_t >= n_w AND n_t >= n_hail THEN 'TORNADO'
              WHEN n_f >= n_h AND n_f >= n_w AND n_f >= n_hail THEN 'FLOOD'
              WHEN n_w >= n_h AND n_w >= n_hail THEN 'WIND'
              WHEN n_h >= n_hail THEN 'HURRICANE' ELSE 'WINTER_STORM' END AS dominant_event_type,
         CASE WHEN greatest(n_t, n_f, n_w, n_h, n_hail) = 0 THEN NULL
              WHEN n_t = greatest(n_t, n_f, n_w, n_h, n_hail) THEN 'TORNADO'
              WHEN n_f = greatest(n_t, n_f, n_w, n_h, n_hail) THEN 'FLOOD'
              WHEN n_w = greatest(n_t, n_f, n_w, n_h, n_hail) THEN 'WIND'
              WHEN n_h = greatest(n_t, n_f, n_w, n_h, n_hail) THEN 'HURRICANE' ELSE 'HAIL' END AS exact_dominant,
         round(percent_rank() OVER (PARTITION BY decade ORDER BY total_damage_2024_usd ASC NULLS FIRST) * 100, 1)
           AS damage_percentile_in_decade
  FROM risk0
)"""

IMPACT = f"""
imp0 AS (
  SELECT event_type_group, count(*) AS total_events, {cents('total_damage_2024_usd')} AS total_damage_2024_usd,
         {cents('coalesce(property_damage_2024_usd, 0)')} AS total_property_damage_2024_usd,
         {cents('coalesce(crop_damage_2024_usd, 0)')} AS total_crop_damage_2024_usd,
         {cents('total_damage_usd')} AS total_damage_usd_nominal,
         round({cents('total_damage_2024_usd')} / count(*), 2) AS avg_damage_per_event_2024_usd,
         sum(deaths_direct) AS total_deaths_direct, sum(injuries_direct) AS total_injuries_direct,
         round(sum(deaths_direct) / CAST(count(*) AS DOUBLE), 4) AS avg_deaths_per_event
  FROM base_a GROUP BY 1
),
impact AS (
  SELECT *, round(total_damage_2024_usd / (CAST(sum(CAST(total_damage_2024_usd AS DECIMAL(30,2))) OVER () AS DOUBLE))
                  * 100, 2) AS pct_of_total_damage,
         rank() OVER (ORDER BY avg_damage_per_event_2024_usd DESC NULLS LAST) AS rank_by_damage_per_event,
         rank() OVER (ORDER BY total_damage_2024_usd DESC NULLS LAST) AS rank_by_total_damage
  FROM imp0
)"""

SURPRISE = """
lagged AS (
  SELECT state, region, decade, event_count, total_damage_2024_usd, total_deaths_direct, damage_percentile_in_decade,
         lag(total_damage_2024_usd) OVER w AS prior_decade_damage_2024_usd,
         lag(event_count) OVER w AS prior_decade_event_count,
         lag(damage_percentile_in_decade) OVER w AS prior_decade_damage_percentile
  FROM risk WINDOW w AS (PARTITION BY state ORDER BY decade)
),
surprise AS (
  SELECT *, round(total_damage_2024_usd - coalesce(prior_decade_damage_2024_usd, 0), 2) AS damage_delta_2024_usd,
         round((total_damage_2024_usd - prior_decade_damage_2024_usd) / nullif(prior_decade_damage_2024_usd, 0) * 100, 2)
           AS damage_pct_change,
         round(damage_percentile_in_decade - coalesce(prior_decade_damage_percentile, 0), 1) AS percentile_rank_change,
         (damage_percentile_in_decade - coalesce(prior_decade_damage_percentile, 0)) > 20 AS is_surprise_state
  FROM lagged WHERE prior_decade_damage_2024_usd IS NOT NULL
)"""

YEARS = """
years AS (
  SELECT event_year, sum(event_count) AS total_events,
         CAST(sum(CAST(total_damage_2024_usd AS DECIMAL(30,2))) AS DOUBLE) AS total_damage,
         sum(total_deaths_direct) AS total_deaths,
         CAST(sum(CAST(total_damage_2024_usd AS DECIMAL(30,2))) AS DOUBLE) / sum(event_count) AS avg_damage_per_event
  FROM sev GROUP BY 1
)"""

STATE_YEAR = f"""
sy AS (
  SELECT state, event_year, count(*) AS state_year_event_count, sum(deaths_direct) AS state_year_deaths,
         {cents('total_damage_2024_usd')} AS state_year_damage
  FROM base_b GROUP BY 1, 2
),
lags AS (
  SELECT state, event_year, lag(state_year_event_count) OVER w AS lag_event_count,
         lag(state_year_deaths) OVER w AS lag_deaths, lag(state_year_damage) OVER w AS lag_damage
  FROM sy WINDOW w AS (PARTITION BY state ORDER BY event_year)
)"""

SCORED = """
scored AS (
  SELECT *, CASE WHEN deaths_direct > 0 THEN 1 ELSE 0 END AS label,
         ((CAST(weather_forecast_office AS BIGINT) * 7919 + CAST(noaa_event_id AS BIGINT) * 31) % 1000) / 1000.0::DOUBLE
           AS score
  FROM base_c
)"""

PARTS = {
    "raw": RAW, "stg": STG, "dims": DIMS, "enr": ENR, "sev": SEVERITY, "risk": RISK, "impact": IMPACT,
    "surprise": SURPRISE, "years": YEARS, "sy": STATE_YEAR, "scored": SCORED,
}

NEEDS = {
    "raw": (), "dims": (), "stg": ("raw",), "enr": ("raw", "stg", "dims"), "sev": ("enr",), "risk": ("enr",),
    "impact": ("enr",), "surprise": ("risk",), "years": ("sev",), "sy": ("enr",), "scored": ("enr",),
}


def with_parts(*wanted: str, then: str, more: str = "") -> str:
    """``WITH`` clause holding the wanted parts and what they need, in dependency order."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS[name]:
            add(needed)
        if name not in order:
            order.append(name)

    for name in wanted:
        add(name)
    ctes = [PARTS[name].strip() for name in order] + ([more.strip()] if more else [])
    return "WITH " + ",\n".join(ctes) + "\n" + then.strip()
