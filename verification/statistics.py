"""Queries of the trend and anomaly operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilscope.operators import anomaly, trend
from perilscope.operators.scaling import fit_scaling, scale
from perilscope.plans import marts
from verification.base_sql import with_parts
from verification.fixture import CUTOFFS, Fixture
from verification.relational import query


def trend_sql(keys: str, digits: int = 6) -> str:
    """Mann-Kendall and Sen on a table ``series(keys, t, x)`` by brute force over all pairs."""
    using = f"({keys})"
    first = keys.split(",")[0].strip()
    return f"""
pairs AS (
  SELECT {', '.join('a.' + k.strip() for k in keys.split(','))}, sign(b.x - a.x) AS sg,
         (b.x - a.x) / CAST(b.t - a.t AS DOUBLE) AS slope
  FROM series a JOIN series b USING {using} WHERE a.t < b.t
),
s AS (SELECT {keys}, CAST(sum(sg) AS BIGINT) AS s, median(slope) AS slope FROM pairs GROUP BY ALL),
tie AS (SELECT {keys}, sum(c * (c - 1) * (2 * c + 5)) AS tie_term, sum(c) AS n
        FROM (SELECT {keys}, x, count(*) AS c FROM series GROUP BY ALL) GROUP BY ALL),
med AS (SELECT {keys}, median(x) AS mx, median(t) AS mt FROM series GROUP BY ALL),
j AS (
  SELECT {keys}, CAST(n AS BIGINT) AS n, s, CAST(n * (n - 1) * (2 * n + 5) - tie_term AS DOUBLE) / 18 AS var_s,
         s / (n * (n - 1) / 2.0::DOUBLE) AS tau, slope, mx - slope * mt AS intercept
  FROM s JOIN tie USING {using} JOIN med USING {using}
),
z AS (SELECT *, CASE WHEN s = 0 THEN 0.0::DOUBLE ELSE (s - sign(s)) / sqrt(var_s) END AS z FROM j),
e AS (SELECT *, abs(z) / sqrt(2.0::DOUBLE) AS u, 1.0::DOUBLE / (1 + 0.3275911 * abs(z) / sqrt(2.0::DOUBLE)) AS k FROM z),
p AS (
  SELECT *, 2 * (1 - 0.5 * (1 + 1 - k * (0.254829592 + k * (-0.284496736 + k * (1.421413741 + k * (-1.453152027
         + k * 1.061405429)))) * exp(-u * u))) AS p FROM e
)
SELECT {keys}, n, CASE WHEN p < 0.05 AND z > 0 THEN 'increasing' WHEN p < 0.05 AND z < 0 THEN 'decreasing'
       ELSE 'no trend' END AS trend, round(p, {digits}) AS p, round(z, {digits}) AS z, round(tau, {digits}) AS tau, s,
       round(var_s, {digits}) AS var_s, round(slope, {digits}) AS slope, round(intercept, {digits}) AS intercept
FROM p WHERE {first} IS NOT NULL"""


def rounded_trend(found: DataFrame, digits: int = 6) -> DataFrame:
    return found.withColumns({c: F.round(c, digits) for c in ("p", "z", "tau", "var_s", "slope", "intercept")})


@query(
    "trend_state_years",
    with_parts("stg", more="""
series AS (SELECT state, event_year AS t, count(*) AS x FROM stg WHERE state IS NOT NULL GROUP BY 1, 2),""" + trend_sql("state").partition("\nSELECT state, n")[0],
               then="SELECT state, n" + trend_sql("state").partition("\nSELECT state, n")[2]),
)
def trend_state_years(f: Fixture) -> DataFrame:
    """Event frequency per state and year."""
    series = f.staged.filter(F.col("state").isNotNull()).groupBy("state", "event_year")
    series = series.agg(F.count(F.lit(1)).alias("events"))
    return rounded_trend(trend.mann_kendall(series, ["state"], "event_year", "events"))


_MONTHS = trend_sql("p_type, measure").partition("\nSELECT p_type, measure, n")


@query(
    "trend_type_months",
    """WITH monthly AS (
  SELECT p_type, year(l_shipdate) * 12 + month(l_shipdate) AS t, count(*) AS events,
         round(CAST(sum(CAST(l_extendedprice AS DECIMAL(20,2))) AS DOUBLE) / count(*), 4) AS mean_price
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2
),
series AS (
  SELECT p_type, 'events' AS measure, t, CAST(events AS DOUBLE) AS x FROM monthly
  UNION ALL SELECT p_type, 'mean_price', t, mean_price FROM monthly
),""" + _MONTHS[0] + "\nSELECT p_type, measure, n" + _MONTHS[2],
)
def trend_type_months(f: Fixture) -> DataFrame:
    """Frequency and mean amount of many monthly series in one job."""
    line = f.table("lineitem").join(f.table("part"), F.col("l_partkey") == F.col("p_partkey"))
    month = (F.year("l_shipdate") * 12 + F.month("l_shipdate")).alias("t")
    total = F.sum(F.col("l_extendedprice").cast("decimal(20,2)")).cast("double")
    monthly = line.groupBy("p_type", month).agg(
        F.count(F.lit(1)).cast("double").alias("events"),
        F.round(total / F.count(F.lit(1)), 4).alias("mean_price"),
    )
    series = monthly.unpivot(["p_type", "t"], ["events", "mean_price"], "measure", "x")
    return rounded_trend(trend.mann_kendall(series, ["p_type", "measure"], "t", "x"))


@query(
    "trend_marked_peaks",
    with_parts("sev", then="""
SELECT event_type_group, event_year, total_damage_2024_usd,
       total_damage_2024_usd = max(total_damage_2024_usd) OVER (PARTITION BY event_type_group) AS is_outlier FROM sev"""),
)
def trend_marked_peaks(f: Fixture) -> DataFrame:
    severity = marts.severity_trends(f.enriched, CUTOFFS)
    series = severity.select("event_type_group", "event_year", "total_damage_2024_usd")
    return trend.mark_peak(series, ["event_type_group"], "total_damage_2024_usd")


STATE_MONTH_SQL = """
sm AS (
  SELECT state, event_year, month(begin_datetime) AS event_month, count(*) AS events,
         CAST(sum(CAST(total_damage_2024_usd AS DECIMAL(20,2))) AS DOUBLE) / count(*) AS damage_per_event,
         sum(deaths_direct) AS deaths FROM base_b GROUP BY 1, 2, 3
)"""
STATE_MONTH_FEATURES = ["events", "damage_per_event", "deaths"]


def state_months(f: Fixture) -> DataFrame:
    from perilscope.plans.enrich import located_events

    base = located_events(f.enriched, CUTOFFS)
    total = F.sum(F.col("total_damage_2024_usd").cast("decimal(20,2)")).cast("double")
    return base.groupBy("state", "event_year", F.month("begin_datetime").alias("event_month")).agg(
        F.count(F.lit(1)).alias("events"),
        (total / F.count(F.lit(1))).alias("damage_per_event"),
        F.sum("deaths_direct").alias("deaths"),
    )


@query(
    "standardise_state_months",
    with_parts("enr", more=STATE_MONTH_SQL, then="""
SELECT state, event_year, event_month, """ + ", ".join(
        f"round((ln(1 + {c}) - avg(ln(1 + {c})) OVER ()) / stddev_pop(ln(1 + {c})) OVER (), 6) AS {c}_z"
        for c in STATE_MONTH_FEATURES
    ) + " FROM sm"),
)
def standardise_state_months(f: Fixture) -> DataFrame:
    logged = state_months(f).withColumns({c: F.log1p(c) for c in STATE_MONTH_FEATURES})
    scaled = scale(logged, fit_scaling(logged, STATE_MONTH_FEATURES), suffix="_z")
    return scaled.select(
        "state", "event_year", "event_month", *[F.round(f"{c}_z", 6).alias(f"{c}_z") for c in STATE_MONTH_FEATURES]
    )


@query("anomaly_state_months")
def anomaly_state_months(f: Fixture) -> DataFrame:
    """Isolation-forest score of every state and month; the lowest tenth is flagged."""
    return anomaly.score_anomalies(
        state_months(f), STATE_MONTH_FEATURES, ["state", "event_year", "event_month"], contamination=0.1
    )
