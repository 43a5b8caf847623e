"""Queries of the file readers and sinks: the given tables are written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilscope.operators import trend
from perilscope.plans import marts
from perilscope.plans.enrich import attach_groups
from perilscope.operators.joins import lookup_join, one_row_per_key
from perilscope.session import shared_folder
from perilscope.sources import census, prices, seeds, warehouse
from perilscope.vocab import STATE_REGIONS, STATES, TYPE_GROUP_ROWS, TYPE_GROUPS
from verification.base_sql import with_parts
from verification.fixture import CUTOFFS, Fixture
from verification.relational import query
from verification.statistics import rounded_trend, trend_sql


def landing(f: Fixture, name: str) -> str:
    return f"{shared_folder(f.spark)}/{name}-{uuid.uuid4().hex}"


@query(
    "source_price_series",
    """WITH y AS (
  SELECT CAST(year(o_orderdate) AS BIGINT) AS year,
         round(CAST(sum(CAST(o_totalprice AS DECIMAL(20,2))) AS DOUBLE) / count(*), 3) AS cpi_annual_avg
  FROM orders GROUP BY 1
)
SELECT year, cpi_annual_avg, CAST(2000 AS BIGINT) AS cpi_base_year,
       round((SELECT cpi_annual_avg FROM y WHERE year = 2000) / cpi_annual_avg, 9) AS deflator FROM y WHERE year >= 1996""",
)
def source_price_series(f: Fixture) -> DataFrame:
    """A padded tab-separated series file with other series and months beside the yearly averages."""
    total = F.sum(F.col("o_totalprice").cast("decimal(20,2)")).cast("double")
    yearly = f.table("orders").groupBy(F.year("o_orderdate").alias("y")).agg(
        F.round(total / F.count(F.lit(1)), 3).alias("v")
    )
    kinds = F.array(
        F.struct(F.lit(prices.SERIES).alias("s"), F.lit("M13").alias("p"), F.lit(1).alias("k")),
        F.struct(F.lit(prices.SERIES).alias("s"), F.lit("M01").alias("p"), F.lit(2).alias("k")),
        F.struct(F.lit("CUUR0000SA0L5").alias("s"), F.lit("M13").alias("p"), F.lit(3).alias("k")),
    )
    lines = yearly.select("y", "v", F.inline(kinds)).select(
        F.concat("s", F.lit("      ")).alias("series_id      "),
        F.col("y").cast("string").alias("year"),
        F.col("p").alias("period"),
        F.concat(F.lit("    "), (F.col("v") * F.col("k")).cast("string")).alias("       value"),
    )
    path = landing(f, "prices")
    writer = lines.write.option("header", True).option("sep", "\t")
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    found = prices.with_deflator(prices.annual_averages(prices.read_series(f.spark, path), CUTOFFS), CUTOFFS)
    return found.withColumn("deflator", F.round("deflator", 9))


@query(
    "source_county_files",
    """WITH people AS (
  SELECT c_nationkey AS k, c_mktsegment AS seg, count(*) AS n FROM customer GROUP BY ALL
)
SELECT 'N' || k AS state_abbrev, lower(seg) AS county_name, n_name AS state_name, CAST(n AS BIGINT) AS population_2020,
       CAST(k + 10.5 AS DOUBLE) AS land_area_sqmi, round(n / CAST(k + 10.5 AS DOUBLE), 4) AS population_density
FROM people JOIN nation ON n_nationkey = k WHERE seg <> 'MACHINERY'""",
)
def source_county_files(f: Fixture) -> DataFrame:
    """Gazetteer and population files with padded headers, other levels, ages and years, and independent cities."""
    nation = f.table("nation").select("n_nationkey", "n_name")
    people = f.table("customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    people = people.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    segment = F.initcap("c_mktsegment")
    name = F.concat(segment, F.when(F.col("c_mktsegment") == "MACHINERY", " city").otherwise(" County"))
    area = people.select(
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string"), F.lit(" ")).alias("USPS"),
        name.alias("NAME"),
        F.concat((F.col("c_nationkey") + 10.5).cast("string"), F.lit("  ")).alias("ALAND_SQMI    "),
    )
    kinds = F.array(*[F.struct(*[F.lit(v).alias(c) for v, c in zip(kind, "lay")]) for kind in ((50, 0, 13), (50, 1, 13), (40, 0, 13), (50, 0, 12))])
    counted = people.select("n_name", name.alias("CTYNAME"), "n", F.inline(kinds)).select(
        F.col("l").alias("SUMLEV"), F.col("n_name").alias("STNAME"), "CTYNAME", F.col("y").alias("YEAR"), F.col("a").alias("AGEGRP"),
        F.col("n").alias("TOT_POP"),
    )
    folder = landing(f, "counties")
    plain = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    area.write.options(**plain, sep="\t").csv(f"{folder}/gazetteer")
    counted.write.options(**plain, encoding="ISO-8859-1").csv(f"{folder}/population")
    gazetteer = census.gazetteer_counties(census.read_gazetteer(f.spark, f"{folder}/gazetteer"))
    known = {row["n_name"]: f"N{row['n_nationkey']}" for row in nation.collect()}  # 25 nations
    population = census.population_counties(census.read_population(f.spark, f"{folder}/population"), known)
    return census.county_density(population, gazetteer)


def rows_sql(rows: tuple) -> str:
    return ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows)


NUMBERED_TYPES = tuple((str(n), raw, group) for n, (raw, group) in enumerate(TYPE_GROUP_ROWS))
NUMBERED_STATES = tuple((str(n), *row) for n, row in enumerate(STATES))


@query(
    "source_seed_lookups",
    f"""WITH t(k, raw, grp) AS (VALUES {rows_sql(NUMBERED_TYPES)}), s(k, state, abbrev, region) AS (VALUES {rows_sql(NUMBERED_STATES)})
SELECT raw AS event_type_raw, grp AS event_type_group, abbrev AS state_abbrev, region, count(*) AS n, sum(CAST(l_quantity AS BIGINT)) AS quantity
FROM lineitem JOIN t ON CAST(t.k AS BIGINT) = l_partkey % {len(TYPE_GROUP_ROWS)} JOIN s ON CAST(s.k AS BIGINT) = l_suppkey % {len(STATES)}
GROUP BY ALL""",
)
def source_seed_lookups(f: Fixture) -> DataFrame:
    """Every event type and every state of the seed files, written as CSV, read and looked up."""
    folder = landing(f, "seeds")
    seeds.type_groups(f.spark).write.option("header", True).csv(f"{folder}/types")
    seeds.state_regions(f.spark).write.option("header", True).csv(f"{folder}/states")
    types = seeds.read_seed(f.spark, f"{folder}/types", TYPE_GROUPS)
    states = seeds.read_seed(f.spark, f"{folder}/states", STATE_REGIONS)
    raw = F.element_at(F.array(*[F.lit(name) for name, _ in TYPE_GROUP_ROWS]), (F.col("l_partkey") % len(TYPE_GROUP_ROWS) + 1).cast("int"))
    state = F.element_at(F.array(*[F.lit(name) for name, *_ in STATES]), (F.col("l_suppkey") % len(STATES) + 1).cast("int"))
    events = f.table("lineitem").select(raw.alias("event_type_raw"), state.alias("state"), "l_quantity")
    found = lookup_join(attach_groups(events, types), one_row_per_key(states, ["state"]), ["state"])
    return found.groupBy("event_type_raw", "event_type_group", "state_abbrev", "region").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )


@query(
    "sink_models_and_views",
    with_parts("sev", "impact", then="""
SELECT 'dbt_marts_mart_severity_trends' AS view, count(*) AS n, sum(event_count) AS events FROM sev
UNION ALL SELECT 'dbt_marts_mart_economic_impact', count(*), sum(total_events) FROM impact"""),
)
def sink_models_and_views(f: Fixture) -> DataFrame:
    """Two marts stored over older and longer versions, registered as views and read by name."""
    folder = landing(f, "marts")
    base = marts.mart_base(f.enriched, CUTOFFS)
    models = {
        "mart_severity_trends": marts.severity_trends(base, CUTOFFS),
        "mart_economic_impact": marts.economic_impact(base, CUTOFFS),
    }
    for name, df in models.items():
        warehouse.replace_table(df.union(df), f"{folder}/{name}")
    stored = warehouse.store_models(models, folder)
    names = [warehouse.register_view(df, name, warehouse.MARTS_SCHEMA) for name, df in stored.items()]
    sums = {names[0]: "event_count", names[1]: "total_events"}
    parts = [
        f.spark.table(name).agg(F.count(F.lit(1)).alias("n"), F.sum(column).alias("events")).select(F.lit(name).alias("view"), "n", "events")
        for name, column in sums.items()
    ]
    return parts[0].union(parts[1])


_DAILY = trend_sql("series_name").partition("\nSELECT series_name, n")


@query(
    "trend_long_series",
    """WITH series AS (
  SELECT 'shipped' AS series_name, CAST(date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) AS t,
         CAST(count(*) AS DOUBLE) AS x FROM lineitem GROUP BY ALL
),""" + _DAILY[0] + "\nSELECT series_name, n" + _DAILY[2],
)
def trend_long_series(f: Fixture) -> DataFrame:
    """Lines shipped per day: far more points than fit the packed route."""
    day = F.date_diff(F.to_date("l_shipdate"), F.lit("1990-01-01").cast("date")).cast("bigint").alias("t")
    series = f.table("lineitem").groupBy(day).agg(F.count(F.lit(1)).cast("double").alias("x"))
    return rounded_trend(trend.mann_kendall(series.withColumn("series_name", F.lit("shipped")), ["series_name"], "t", "x"))
