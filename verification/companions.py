"""Queries that certify fitted models by what SQL can state: optimality, agreement of two forms, closed forms, counts.

Also the load of event files over several versions of a year.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilscope.operators import anomaly, models, resample
from perilscope.operators import features as ft
from perilscope.operators.scaling import fit_scaling, scale
from perilscope.plans import enrich, marts, study
from perilscope.plans.marts import DOMINANT_FALLBACK, DOMINANT_ORDER
from perilscope.session import cut_lineage, shared_folder
from perilscope.sources import events as event_files
from perilscope.sources import seeds
from perilscope.vocab import EVENT_GROUPS, TYPE_GROUP_ROWS
from verification.base_sql import with_parts
from verification.fixture import Fixture
from verification.modelling import SETUP, scored
from verification.readers import NUMBERED_TYPES, rows_sql
from verification.relational import query
from verification.statistics import STATE_MONTH_FEATURES, state_months


STAGED = """event_id, noaa_event_id, noaa_episode_id, event_year, event_month, begin_datetime, end_datetime, state, state_fips,
county_zone_name, county_zone_type, event_type_raw, weather_forecast_office, injuries_direct, injuries_indirect, deaths_direct, deaths_indirect,
property_damage_usd, crop_damage_usd, tornado_f_scale, tornado_length_miles, tornado_width_yards, magnitude, magnitude_type,
hurricane_category, episode_narrative, event_narrative, is_pre_standardization"""


def plain_times(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("begin_datetime", "end_datetime")})


@query("staging_all_columns", with_parts("stg", then=f"SELECT {STAGED} FROM stg"))
def staging_all_columns(f: Fixture) -> DataFrame:
    """All 28 columns of staging, with track sizes, categories, indirect casualties and narratives."""
    return plain_times(f.staged_full)


@query("join_all_columns", with_parts("enr", then=f"SELECT {', '.join(enrich.ENRICHED_COLUMNS)} FROM enr"))
def join_all_columns(f: Fixture) -> DataFrame:
    """All 39 columns of the enriched events."""
    return plain_times(enrich.enrich_events(f.staged_full, f.groups, f.cpi, f.regions, f.population))


def _order_sql(column: str, names: tuple[str, ...]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{name}' THEN {k}" for k, name in enumerate(names)) + f" ELSE {len(names)} END"


EXACT_ORDER = (*DOMINANT_ORDER, *[g for g in EVENT_GROUPS if g not in DOMINANT_ORDER])


@query(
    "aggregate_every_group_wins",
    f"""WITH t(k, raw, grp) AS (VALUES {rows_sql(NUMBERED_TYPES)}),
e AS (SELECT CAST(l_suppkey % 44 AS BIGINT) AS place, CASE WHEN l_linenumber <= 3 THEN list_extract({list(EVENT_GROUPS)}, CAST(l_suppkey % 11 + 1 AS INTEGER)) ELSE grp END AS g
      FROM lineitem JOIN t ON CAST(t.k AS BIGINT) = l_partkey % {len(TYPE_GROUP_ROWS)}),
n AS (SELECT place, g, count(*) AS c FROM e GROUP BY 1, 2),
best AS (SELECT place, max(c) AS top FROM n GROUP BY 1),
ties AS (SELECT n.*, {_order_sql("g", EXACT_ORDER)} AS o FROM n JOIN best USING (place) WHERE c = top)
SELECT place, max(c) AS top, arg_min(g, o) AS exact, CASE WHEN min(o) < {len(DOMINANT_ORDER)} THEN arg_min(g, o) ELSE '{DOMINANT_FALLBACK}' END AS dominant
FROM ties GROUP BY 1""",
)
def aggregate_every_group_wins(f: Fixture) -> DataFrame:
    """All 61 types and 11 groups; each group leads in some places, where the published rule and the true mode differ."""
    raw = F.element_at(F.array(*[F.lit(name) for name, _ in TYPE_GROUP_ROWS]), (F.col("l_partkey") % len(TYPE_GROUP_ROWS) + 1).cast("int"))
    lines = f.table("lineitem").select((F.col("l_suppkey") % 44).cast("bigint").alias("place"), "l_linenumber", raw.alias("event_type_raw"))
    events = enrich.attach_groups(lines, seeds.type_groups(f.spark))
    favourite = F.element_at(F.array(*[F.lit(g) for g in EVENT_GROUPS]), (F.col("place") % 11 + 1).cast("int"))
    group = F.when(F.col("l_linenumber") <= 3, favourite).otherwise(F.col("event_type_group"))
    counts = events.withColumn("g", group).groupBy("place").agg(*marts.group_counts(F.col("g")))
    top = F.greatest(*[F.col(f"n_{g}") for g in EVENT_GROUPS]).alias("top")
    return counts.select("place", top, marts.dominant_group("exact").alias("exact"), marts.dominant_group().alias("dominant"))


@query(
    "model_logistic_optimum",
    with_parts("scored", then="""
SELECT count(*) AS n, count(*) FILTER (label = 1) AS positives, CAST(count(*) AS DOUBLE) AS weight, TRUE AS at_optimum
FROM scored WHERE event_year <= 1999"""),
)
def model_logistic_optimum(f: Fixture) -> DataFrame:
    """The fitted coefficients are where the penalised weighted loss is flat; balanced weights add up to the rows."""
    frame = cut_lineage(study.fatality_frame(f.enriched, SETUP))
    train, _ = ft.split_by_year(frame, SETUP.last_train_year)
    scaled, _ = study.standardised(train, train, study.NUMERIC)
    ready = cut_lineage(ft.assemble(ft.balanced_weights(scaled, study.LABEL), SETUP.feature_names()))
    model = models.fit_logistic(ready, study.LABEL, "weight")
    found = models.logistic_gradient(model, ready, study.LABEL, "weight")
    steepest = F.array_max(F.transform("gradient", lambda g: F.abs(g)))
    positives = ready.agg(F.count_if(F.col(study.LABEL) == 1)).scalar()
    return found.select(
        F.col("rows").alias("n"), positives.alias("positives"), F.round("weight", 4).alias("weight"), (steepest < 1e-5).alias("at_optimum")
    )


@query(
    "model_trees_as_expression",
    with_parts("scored", then="""
SELECT count(*) AS n, count(*) AS same_score, count(*) AS same_call, 5 AS trees, TRUE AS same_importance
FROM scored WHERE event_year > 1999"""),
)
def model_trees_as_expression(f: Fixture) -> DataFrame:
    """A boosted model as a table of nodes: CASE expressions score every test row as the model does, gains give its importances."""
    model, _, test, names = study.weighted_model(f.enriched, SETUP)
    nodes = cut_lineage(models.tree_nodes(f.spark, model))
    judged = models.with_score(model, test.select("features", *names), "by_model")
    judged = judged.withColumn("by_nodes", models.tree_expression(nodes, names))
    theirs = models.importances(f.spark, model, names).withColumnRenamed("importance", "theirs")
    apart = models.tree_importances(nodes, names).join(theirs, "feature").agg(F.max(F.abs(F.col("importance") - F.col("theirs")))).scalar()
    return judged.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.abs(F.col("by_model") - F.col("by_nodes")) <= 1e-12).alias("same_score"),
        F.count_if((F.col("by_model") >= 0.5) == (F.col("by_nodes") >= 0.5)).alias("same_call"),
    ).select("*", nodes.agg(F.count_distinct("tree").cast("int")).scalar().alias("trees"), (apart <= 1e-12).alias("same_importance"))


@query(
    "calibration_map",
    with_parts("scored", more="""
points AS (SELECT score AS s, sum(label) AS y, count(*) AS w FROM scored GROUP BY 1),
numbered AS (SELECT *, row_number() OVER (ORDER BY s) AS k, sum(y) OVER (ORDER BY s) AS ys, sum(w) OVER (ORDER BY s) AS ws FROM points),
means AS (SELECT a.k AS i, b.k AS j, (b.ys - a.ys + a.y) / CAST(b.ws - a.ws + a.w AS DOUBLE) AS m FROM numbered a JOIN numbered b ON b.k >= a.k),
ahead AS (SELECT i, j, min(m) OVER (PARTITION BY i ORDER BY j DESC) AS least FROM means)""", then="""
SELECT s AS score, CAST(w AS BIGINT) AS n, round(max(least), 9) AS calibrated FROM ahead JOIN numbered ON k = j GROUP BY 1, 2"""),
)
def calibration_map(f: Fixture) -> DataFrame:
    """The isotonic map at every score: the greatest over starts of the least mean up to an end."""
    rows = cut_lineage(scored(f).select("score", F.col("label").cast("double").alias("label")))
    model = models.fit_calibration(rows, "score", "label")
    points = rows.groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    return models.with_calibrated(model, points, "score", "calibrated").withColumn("calibrated", F.round("calibrated", 9))


@query(
    "anomaly_walk",
    with_parts("enr", then="SELECT count(*) AS n, count(*) AS same, 100 AS trees FROM (SELECT DISTINCT state, event_year, event_month FROM base_b)"),
)
def anomaly_walk(f: Fixture) -> DataFrame:
    """The forest as a table: rows walk down by a join per level and end at the scores of the packed forest."""
    keys = ["state", "event_year", "event_month"]
    months = state_months(f)
    logged = cut_lineage(months.select(*keys, *[F.log1p(F.col(c).cast("double")).alias(c) for c in STATE_MONTH_FEATURES]))
    ready = cut_lineage(scale(logged, fit_scaling(logged, STATE_MONTH_FEATURES)))
    nodes, size = anomaly.grow_forest(ready, STATE_MONTH_FEATURES, keys)
    nodes = cut_lineage(nodes)
    packed = anomaly.score_forest(ready, nodes, STATE_MONTH_FEATURES, size, "packed")
    walked = anomaly.walk_forest(ready, nodes, STATE_MONTH_FEATURES, keys, size, "walked")
    both = packed.select(*keys, "packed").join(walked.select(*keys, "walked"), keys)
    return both.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.abs(F.col("packed") - F.col("walked")) <= 1e-12).alias("same")
    ).select("*", nodes.agg(F.count_distinct("tree").cast("int")).scalar().alias("trees"))


@query(
    "smote_counts",
    with_parts("scored", more="""
train AS (SELECT * FROM scored WHERE event_year <= 1999),
near AS (SELECT count(*) FILTER (label = 1) AS n1, count(*) FILTER (label = 0) AS n0 FROM train WHERE event_type_group IN ('TORNADO', 'HURRICANE'))""", then="""
SELECT label, CAST(count(*) + CASE WHEN label = 1 THEN greatest(CAST(floor(0.5 * max(n0)) AS BIGINT) - max(n1), 0) ELSE 0 END AS BIGINT) AS n
FROM train, near GROUP BY 1"""),
)
def smote_counts(f: Fixture) -> DataFrame:
    """All rows and as many new positives as the target groups lack."""
    train, _ = ft.split_by_year(cut_lineage(study.fatality_frame(f.enriched, SETUP)), SETUP.last_train_year)
    grown = resample.targeted_smote(train, SETUP.feature_names(), study.LABEL, "event_type_group", ("TORNADO", "HURRICANE"), ratio=0.5)
    return grown.groupBy(F.col(study.LABEL).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "smote_neighbours",
    """WITH p AS (
  SELECT CAST(l_quantity AS DOUBLE) AS a, round(CAST(l_discount AS DOUBLE) * 100) AS b, round(CAST(l_tax AS DOUBLE) * 100) AS c,
         round(CAST(l_extendedprice AS DOUBLE) / 1000) AS d, count(*) AS copies
  FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 7 GROUP BY ALL
),
pairs AS (
  SELECT p.a, p.b, p.c, p.d, p.copies, q.copies AS others,
         sqrt((p.a - q.a) * (p.a - q.a) + (p.b - q.b) * (p.b - q.b) + (p.c - q.c) * (p.c - q.c) + (p.d - q.d) * (p.d - q.d)) AS dist
  FROM p, p q
),
reach AS (SELECT *, sum(others) OVER (PARTITION BY a, b, c, d ORDER BY dist) AS held FROM pairs)
SELECT a, b, c, d, max(copies) AS copies, round(min(dist) FILTER (held > 5), 6) AS kth FROM reach GROUP BY 1, 2, 3, 4""",
)
def smote_neighbours(f: Fixture) -> DataFrame:
    """The distance at which each distinct point of a minority has five more rows, against all pairs."""
    rows = f.table("lineitem").filter("l_returnflag = 'R' AND l_linenumber = 7").select(
        F.col("l_quantity").cast("double").alias("a"),
        F.round(F.col("l_discount").cast("double") * 100).alias("b"),
        F.round(F.col("l_tax").cast("double") * 100).alias("c"),
        F.round(F.col("l_extendedprice").cast("double") / 1000).alias("d"),
    )
    points = resample.merged_points(rows, list("abcd"))
    near = resample.nearest_points(points, 5).select("id", F.round("kth", 6).alias("kth"))
    parts = [F.get("x", F.lit(k)).alias(name) for k, name in enumerate("abcd")]
    return points.join(near, "id").select(*parts, "copies", "kth")


LATIN = "Cami\xf3n Condado"


def _land(f: Fixture, folder: str, rows: DataFrame, name: str, extra: bool) -> None:
    """One gzip CSV file of that name; Spark names its own files, so the only part is renamed in the shared folder.

    Only the rows of the file come together in one task: the table is scanned and filtered by many."""
    spark, part = f.spark, f"{shared_folder(f.spark)}/part-{uuid.uuid4().hex}"
    columns = [F.lit("x").alias("NEW_COLUMN"), *rows.columns] if extra else rows.columns
    writer = rows.select(*columns).repartition(1).write.option("header", True).option("encoding", "ISO-8859-1").option("escape", '"')
    writer.option("compression", "gzip").csv(part)
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    files = path(part).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(folder))
    [made] = [s.getPath() for s in files.listStatus(path(part)) if s.getPath().getName().startswith("part-")]
    files.rename(made, path(f"{folder}/{name}"))


@query(
    "load_event_versions",
    f"""WITH e AS (
  SELECT CAST(year(l_shipdate) AS BIGINT) AS event_year, l_orderkey, CAST(floor(l_quantity) AS BIGINT) AS q FROM lineitem
  WHERE year(l_shipdate) IN (1996, 1997, 1998)
)
SELECT event_year, count(*) AS n, count(*) FILTER (q % 10 <> 3) AS with_deaths, CAST(sum(CASE WHEN q % 10 <> 3 THEN q END) AS BIGINT) AS deaths,
       count(*) FILTER (l_orderkey % 2 = 0) AS narratives, count(*) AS latin, count(*) AS noted,
       CASE event_year WHEN 1996 THEN '1' WHEN 1997 THEN '2' ELSE '1,2,3' END AS loads,
       'StormEvents_details-ftp_v1.0_d' || event_year || '_c20240201.csv.gz' AS file_name, CAST(0 AS BIGINT) AS damaged
FROM e GROUP BY 1""",
)
def load_event_versions(f: Fixture) -> DataFrame:
    """Three loads of a landing folder: two versions of a year, two headers, foreign names, a year before the first, one that comes later.

    The files hold unreadable integers, quoted line breaks and a latin-1 letter. loads: which of the three loads took the year.
    """
    day, quantity = F.to_date("l_shipdate"), F.floor("l_quantity").cast("bigint")
    rows = f.table("lineitem").select(
        F.col("l_orderkey").cast("string").alias("EVENT_ID"),
        F.lit("1").alias("EPISODE_ID"),
        F.year(day).alias("YEAR"),
        F.col("l_returnflag").alias("STATE"),
        F.lit("Flood").alias("EVENT_TYPE"),
        F.lit(LATIN).alias("CZ_NAME"),
        F.when(quantity % 10 == 3, F.lit("n/a")).otherwise(quantity.cast("string")).alias("DEATHS_DIRECT"),
        F.when(F.col("l_orderkey") % 2 == 0, F.lit('first line\nsecond, "quoted" line')).alias("EVENT_NARRATIVE"),
    )
    base = f"{shared_folder(f.spark)}/versions-{uuid.uuid4().hex}"
    landing, table = f"{base}/landing", f"{base}/raw"
    name = "StormEvents_details-ftp_v1.0_d{}_c{}.csv.gz".format
    year = {y: rows.filter(F.col("YEAR") == y) for y in (1995, 1996, 1997, 1998)}
    _land(f, landing, year[1996].filter("EVENT_ID % 2 = 0"), name(1996, "20240101"), extra=False)
    for y in (1995, 1996, 1998):
        _land(f, landing, year[y], name(y, "20240201"), extra=y == 1998)
    _land(f, landing, year[1997], "StormEvents_fatalities-ftp_v1.0_d1997_c20240201.csv.gz", extra=False)
    _land(f, landing, year[1997], "StormEvents_details_without_a_year.csv.gz", extra=False)
    taken = [event_files.load_events(f.spark, landing, table, current_year=1998, min_year=1996)]
    _land(f, landing, year[1997], name(1997, "20240201"), extra=True)
    taken += [event_files.load_events(f.spark, landing, table, current_year=1998, min_year=1996) for _ in range(2)]
    loads = {y: ",".join(str(k + 1) for k, years in enumerate(taken) if y in years) for y in sorted({y for years in taken for y in years})}
    stored = f.spark.read.parquet(table).groupBy(F.col("YEAR").cast("bigint").alias("event_year")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("DEATHS_DIRECT").alias("with_deaths"),
        F.sum("DEATHS_DIRECT").alias("deaths"),
        F.count_if(F.col("EVENT_NARRATIVE") == 'first line\nsecond, "quoted" line').alias("narratives"),
        F.count_if(F.col("CZ_NAME") == LATIN).alias("latin"),
    )
    noted = event_files.read_manifest(f.spark, table).select(F.col("year").alias("event_year"), F.col("rows").alias("noted"), "file_name")
    times = F.element_at(F.create_map(*[F.lit(v) for pair in loads.items() for v in pair]), F.col("event_year").cast("int"))
    damaged = event_files.damaged_years(f.spark, table).count()
    return stored.join(noted, "event_year", "full").select("*", times.alias("loads"), F.lit(damaged).cast("bigint").alias("damaged"))
