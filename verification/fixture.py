"""Adapter: the shared test tables seen as raw event, price, region and population sources."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perilscope.plans import enrich, staging
from perilscope.session import prepare
from perilscope.sources.events import conform
from perilscope.sources.prices import with_deflator
from perilscope.sources.seeds import fixed_rows
from perilscope.vocab import MONTHS, RAW_EVENTS, REAL, TYPE_GROUPS, WHOLE, Cutoffs, columns

CUTOFFS = Cutoffs(min_year=1996, partial_year=2001, base_year=2000)

# Fixture rules: part type -> group, and the quantity from which an event counts as deadly.
GROUP_OF_TYPE = {"ECONOMY": "WIND", "SMALL": "HAIL", "LARGE": "FLOOD", "MEDIUM": "TORNADO", "STANDARD": "HURRICANE"}
DEADLY_FROM = {"STANDARD": 40, "MEDIUM": 44, "LARGE": 46, "SMALL": 50}
DEADLY_DEFAULT = 48
PRICE_INDEX = {1995: 152.4, 1996: 156.9, 1997: 160.5, 1998: 163.0, 1999: 166.6, 2000: 172.2}
LINE_COLUMNS = """l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_returnflag
l_shipdate""".split()
FIXTURE_REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def raw_events(
    line: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame, part: DataFrame, every_column: bool = False
) -> DataFrame:
    """Lines as raw events; ``every_column`` also fills the columns that most queries leave empty."""
    line = line.select(*LINE_COLUMNS)
    # Orders meet their customers first, so that the lines are shuffled for two joins, not for three.
    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    joined = line.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    number = F.col("l_linenumber")
    quantity = F.floor("l_quantity").cast("bigint")
    q = quantity.cast("string")
    threshold = F.lit(DEADLY_DEFAULT)
    for kind, level in DEADLY_FROM.items():
        threshold = F.when(F.col("p_type") == kind, level).otherwise(threshold)
    month = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month("l_shipdate"))
    begin = F.upper(F.date_format("l_shipdate", "dd-MMM-yy HH:mm:ss"))
    filled = [
        F.col("l_orderkey").cast("string").alias("EVENT_ID"),
        F.col("l_suppkey").cast("string").alias("EPISODE_ID"),
        F.year("l_shipdate").alias("YEAR"),
        F.when(F.col("n_nationkey") != 24, F.upper(F.replace("n_name", F.lit("_"), F.lit(" ")))).alias("STATE"),
        month.alias("MONTH_NAME"),
        begin.alias("BEGIN_DATE_TIME"),
        F.concat(F.substring(begin, 1, 9), F.lit(" 23:59:59")).alias("END_DATE_TIME"),
        F.col("p_type").alias("EVENT_TYPE"),
        F.col("l_partkey").cast("string").alias("WFO"),
        F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" County")).alias("CZ_NAME"),
        F.when(F.col("l_returnflag") == "N", "Z").otherwise("C").alias("CZ_TYPE"),
        F.when(quantity >= threshold, quantity - threshold + 1)
        .when(number == 7, F.lit(None))
        .otherwise(0)
        .alias("DEATHS_DIRECT"),
        F.when(number != 7, quantity % 5).alias("INJURIES_DIRECT"),
        F.when(number == 1, F.concat(q, F.lit(".00K")))
        .when(number == 2, F.concat(q, F.lit(".5m")))
        .when(number == 3, F.concat(q, F.lit("T")))
        .when(number == 4, " ")
        .when(number == 5, "K")
        .when(number == 6, F.floor("l_extendedprice").cast("bigint").cast("string"))
        .when((number == 7) & (quantity == 50), "1.5B")
        .alias("DAMAGE_PROPERTY"),
        F.when(F.col("l_discount") >= 0.05, F.concat(q, F.lit("K"))).otherwise("0").alias("DAMAGE_CROPS"),
        F.when(F.col("l_returnflag") != "N", (F.col("l_extendedprice") / 1000).cast("string")).alias("MAGNITUDE"),
        F.when(
            F.col("p_type") == "MEDIUM",
            F.when(number == 7, "EFU").otherwise(
                F.concat(F.when(number % 2 == 0, "EF").otherwise("F"), (number % 6).cast("string"))
            ),
        ).alias("TOR_F_SCALE"),
    ]
    if not every_column:
        return conform(joined.select(*filled), RAW_EVENTS)
    tornado, returned = F.col("p_type") == "MEDIUM", F.col("l_returnflag")
    more = [
        F.col("n_nationkey").cast("string").alias("STATE_FIPS"),
        F.when(number == 2, quantity % 3).alias("INJURIES_INDIRECT"),
        F.when(number == 3, quantity % 2).alias("DEATHS_INDIRECT"),
        F.when(tornado, F.concat(F.floor(quantity / 10).cast("string"), F.lit(".5"))).alias("TOR_LENGTH"),
        F.when(tornado, F.when(number == 5, "wide").otherwise(q)).alias("TOR_WIDTH"),
        F.when(returned == "A", "EG").when(returned != "N", "MG").alias("MAGNITUDE_TYPE"),
        F.when(F.col("p_type") == "STANDARD", (number % 5 + 1).cast("string")).alias("CATEGORY"),
        F.concat(F.lit("Episode "), F.col("l_suppkey").cast("string")).alias("EPISODE_NARRATIVE"),
        F.when(number % 2 == 1, F.concat(F.lit("Event "), F.col("l_orderkey").cast("string"), F.lit(', "seen"'))).alias("EVENT_NARRATIVE"),
    ]
    return conform(joined.select(*filled, *more), RAW_EVENTS)


def raw_prices(spark: SparkSession) -> DataFrame:
    rows = fixed_rows(spark, PRICE_INDEX.items(), columns(year=WHOLE, cpi_annual_avg=REAL))
    return with_deflator(rows, CUTOFFS)


def groups(spark: SparkSession) -> DataFrame:
    return fixed_rows(spark, GROUP_OF_TYPE.items(), TYPE_GROUPS)


def regions(nation: DataFrame, region: DataFrame) -> DataFrame:
    return (
        nation.filter(F.col("n_nationkey") != 23)
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.initcap(F.replace("n_name", F.lit("_"), F.lit(" "))).alias("state"),
            F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("state_abbrev"),
            F.col("r_name").alias("region"),
        )
    )


def raw_population(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Customers per (nation, segment), plus one repeated key."""
    people = customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("people"))
    people = people.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    repeated = people.filter((F.col("n_nationkey") == 0) & (F.col("c_mktsegment") == "BUILDING"))
    people = people.unionByName(repeated.withColumn("people", F.lit(1).cast("bigint")))
    area = (F.col("n_nationkey") + 10).cast("double")
    return people.select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("state_abbrev"),
        F.col("c_mktsegment").alias("county_name"),
        F.replace("n_name", F.lit("_"), F.lit(" ")).alias("state_name"),
        F.col("people").alias("population_2020"),
        area.alias("land_area_sqmi"),
        F.round(F.col("people") / area, 4).alias("population_density"),
    )


class Fixture:
    """Lazily built inputs of one data folder; each table is opened once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def raw(self) -> DataFrame:
        return raw_events(*[self.table(t) for t in ("lineitem", "orders", "customer", "nation", "part")])

    @cached_property
    def staged_full(self) -> DataFrame:
        raw = raw_events(*[self.table(t) for t in ("lineitem", "orders", "customer", "nation", "part")], every_column=True)
        return staging.stage_events(raw, CUTOFFS)

    @cached_property
    def staged(self) -> DataFrame:
        return staging.stage_events(self.raw, CUTOFFS)

    @cached_property
    def cpi(self) -> DataFrame:
        return staging.stage_cpi(raw_prices(self.spark))

    @cached_property
    def population(self) -> DataFrame:
        return staging.stage_population(raw_population(self.table("customer"), self.table("nation")))

    @cached_property
    def regions(self) -> DataFrame:
        return regions(self.table("nation"), self.table("region"))

    @cached_property
    def groups(self) -> DataFrame:
        return groups(self.spark)

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich.enrich_events(self.staged, self.groups, self.cpi, self.regions, self.population)
