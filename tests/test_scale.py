"""Steps that must not be repeated or run uncompiled on large tables; every test builds its own rows."""

import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F

from perilscope.functions import scalars as fn
from perilscope.operators import metrics
from perilscope.plans import marts, study
from perilscope.session import prepare
from perilscope.sources import events
from verification.fixture import CUTOFFS
from verification.modelling import SETUP

COLUMNS = """event_id string, event_year bigint, event_month string, begin_datetime timestamp, event_type_group string, region string, state string,
county_zone_name string, decade bigint, tornado_f_scale string, magnitude double, magnitude_type string, hurricane_category double,
population_density double, deaths_direct bigint, injuries_direct bigint, property_damage_2024_usd double, crop_damage_2024_usd double,
total_damage_usd double, total_damage_2024_usd double, is_pre_standardization boolean"""


@pytest.fixture()
def stored(spark, scratch):
    day = dt.datetime(1997, 5, 1)
    rows = [
        (f"{k}-1997", 1997 + k, "May", day, "HAIL", "ASIA", "Japan", "A", 1990, None, None, None, None, 2.0, k, 0, 1.0, 2.0, 3.0, 4.0, False)
        for k in range(3)
    ]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{scratch}/enriched")
    return spark.read.parquet(f"{scratch}/enriched")


def reads(df):
    return any("/enriched/" in path for path in df.inputFiles())


def test_frames_read_the_events_once(stored):
    assert reads(stored)
    for made in (study.fatality_frame(stored, SETUP), study.tier_frame(stored, SETUP, 1996, 2000), marts.mart_base(stored, CUTOFFS)):
        assert not reads(made) and made.count() == 3


def test_files_are_parsed_once_for_the_table(spark, scratch):
    with gzip.open(f"{scratch}/StormEvents_details-ftp_v1.0_d1999_c20200101.csv.gz", "wt", encoding="latin-1") as handle:
        handle.write('X,EVENT_ID,YEAR,DEATHS_DIRECT,EVENT_NARRATIVE\nx,1,1999,n/a,"two\nlines, ""quoted"""\n')
    plain, kept = events.read_events(spark, scratch), events.read_events(spark, scratch, store=True)
    assert not any(path.endswith(".csv.gz") for path in kept.inputFiles())
    assert kept.schema == plain.schema and kept.collect() == plain.collect()


def test_copies_count_as_rows(spark):
    merged = spark.createDataFrame([(1.0, 0.9, 3), (0.0, 0.9, 2), (1.0, 0.2, 1), (0.0, 0.1, 5)], "y double, s double, n bigint")
    rows = merged.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("n")))).drop("n", "_")
    assert metrics.compare(merged, ["s"], "y", copies="n").collect() == metrics.compare(rows, ["s"], "y").collect()


def test_large_methods_are_left_to_split_code(spark):
    prepare(spark)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_plain_times_need_no_pattern(spark):
    texts = ["28-APR-97 14:45:00", "28-apr-68 00:00:00", "30-FEB-01 00:00:00", "28-XXX-97 14:45:00", "28-DEC-70 24:00:00", " 1-SEP-05 01:02:03 "]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(fn.event_timestamp(F.col("t")).cast("string")).collect()
    assert [row[0] for row in found] == ["1997-04-28 14:45:00", "2068-04-28 00:00:00", None, None, None, "2005-09-01 01:02:03"]
