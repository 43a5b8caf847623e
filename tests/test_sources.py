import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from perilscope.plans.staging import stage_events
from perilscope.session import cut_lineage
from perilscope.sources import census, events, prices, seeds, warehouse
from perilscope.vocab import RAW_EVENTS, STATE_REGIONS, TYPE_GROUPS, Cutoffs


def write_gz(path: Path, text: str) -> None:
    with gzip.open(path, "wt", encoding="latin-1", newline="") as handle:
        handle.write(text)


def details(year, created, rows, extra=False):
    head = "EVENT_ID,EPISODE_ID,STATE,YEAR,EVENT_TYPE,CZ_NAME,DEATHS_DIRECT,DAMAGE_PROPERTY,EVENT_NARRATIVE"
    if extra:
        head = "NEW_COLUMN," + head
    lines = [("x," if extra else "") + r for r in rows]
    return f"StormEvents_details-ftp_v1.0_d{year}_c{created}.csv.gz", head + "\n" + "\n".join(lines) + "\n"


@pytest.fixture()
def landed(scratch):
    folder = Path(scratch) / "landed"
    folder.mkdir()
    files = [
        details(1995, "20200101", ['1,1,TEXAS,1995,Flood,Pi\xf1on County,0,5K,old']),
        details(1999, "20200101", ['2,1,TEXAS,1999,Flood,A County,0,1K,superseded']),
        details(1999, "20210101", ['2,1,TEXAS,1999,Flood,Pi\xf1on County,1,2K,"two\nlines, ""quoted"""', '3,1,OHIO,1999,Hail,B,bad,,x']),
        details(2000, "20210101", ['4,2,OHIO,2000,Tornado,B,,1.5B,plain'], extra=True),
        ("StormEvents_fatalities-ftp_v1.0_d2000_c20210101.csv.gz", "A\n1\n"),
    ]
    for name, text in files:
        write_gz(folder / name, text)
    return str(folder)


def test_listing_versions_and_plan(spark, landed):
    files = events.list_files(spark, landed)
    assert files.count() == 4
    newest = {r.year: r.file_name for r in events.latest_versions(files).collect()}
    assert set(newest) == {1995, 1999, 2000} and "c20210101" in newest[1999]
    loaded = spark.createDataFrame([(1999,)], "year bigint")
    assert {r.year for r in events.plan_years(files, loaded, 2026).collect()} == {2000, 2026}
    assert {r.year for r in events.plan_years(files, loaded, 1999).collect()} == {2000, 1999}


def test_one_scan_per_header(spark, scratch):
    """30 files with two headers, one in an odd place, one empty file and a blank in the folder's name."""
    folder = Path(scratch) / "in two parts"
    folder.mkdir()
    for n in range(30):
        name, text = details(1970 + n, "20210101", [f'{n},1,TEXAS,{1970 + n},Flood,Pi\xf1on,{n},0,"a\nb"'] * 50, extra=n % 7 == 0)
        write_gz(folder / name, text)
    write_gz(folder / "StormEvents_details-ftp_v1.0_d2005_c20210101.csv.gz", "")
    read = events.read_events(spark, str(folder))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2
    rows = read.collect()
    assert len(rows) == 1500 and read.schema == RAW_EVENTS
    assert {(r.EVENT_ID, r.YEAR, r.DEATHS_DIRECT, r.CZ_NAME, r.EVENT_NARRATIVE) for r in rows} == {(str(n), 1970 + n, n, "Pi\xf1on", "a\nb") for n in range(30)}
    files = [(r.path, r.location) for r in events.list_files(spark, str(folder)).collect()]
    assert len(events.read_headers(spark, files)) == 30 and events.read_headers(spark, []) == {}


def test_headers_of_files_that_share_a_task(spark, landed):
    files = [(r.path, r.location) for r in events.list_files(spark, landed).collect()]
    usual = spark.conf.get("spark.sql.files.openCostInBytes")
    found = []
    for cost in ("1", "128m"):
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
        found.append(events.read_headers(spark, files))
    spark.conf.set("spark.sql.files.openCostInBytes", usual)
    assert len(found[0]) == 4 and found[0] == found[1]


def test_header_names():
    assert events.header_columns('\ufeffA,"B, C",A\r') == ["A", "B, C", "A_2"]


def test_manifest_decides_what_is_loaded_again(spark, landed, scratch):
    table = f"{scratch}/raw"
    assert events.load_events(spark, landed, table, current_year=2000) == [1999, 2000]
    noted = {r.year: r for r in events.read_manifest(spark, table).collect()}
    assert {y: (r.rows, "c20210101" in r.file_name) for y, r in noted.items()} == {1999: (2, True), 2000: (1, True)}
    assert events.damaged_years(spark, table).count() == 0 and events.years_with_repeats(spark, table).count() == 0
    newer, text = details(1999, "20220101", ["9,1,TEXAS,1999,Flood,A,0,1K,newer", "9,1,TEXAS,1999,Flood,B,0,1K,again", ",1,TEXAS,1999,Flood,B,0,1K,no id"])
    write_gz(Path(landed) / newer, text)
    assert events.load_events(spark, landed, table, current_year=2000) == [2000]
    assert events.load_events(spark, landed, table, current_year=2000, reload_changed=True) == [1999, 2000]
    assert events.load_events(spark, landed, table, current_year=2000, reload_changed=True) == [2000]
    noted = {r.year: r for r in events.read_manifest(spark, table).collect()}
    assert noted[1999].file_name == newer and noted[1999].rows == 3 and len(noted) == 2
    assert [tuple(r) for r in events.years_with_repeats(spark, table).collect()] == [(1999, 3, 1)]
    spark.read.parquet(table).filter("YEAR = 2000").limit(0).write.mode("overwrite").parquet(f"{table}/YEAR=2000")
    assert [tuple(r) for r in events.damaged_years(spark, table).collect()] == [(2000, 1, 0)]
    assert events.load_events(spark, landed, table, current_year=1999) == [1999, 2000], "a year that is gone from the table is loaded again"


def test_load_is_idempotent_and_keeps_other_years(spark, landed, scratch):
    table = f"{scratch}/raw"
    assert events.loaded_years(spark, table).count() == 0
    assert events.load_events(spark, landed, table, current_year=2000) == [1999, 2000]
    first = sorted(map(str, spark.read.parquet(table).collect()))
    assert events.load_events(spark, landed, table, current_year=2000) == [2000]
    assert events.load_events(spark, landed, table, current_year=2000, year=1999) == [1999]
    assert sorted(map(str, spark.read.parquet(table).collect())) == first
    rows = {r.EVENT_ID: r for r in spark.read.parquet(table).collect()}
    assert set(rows) == {"2", "3", "4"}
    assert rows["2"].CZ_NAME == "Piñon County" and rows["2"].EVENT_NARRATIVE == 'two\nlines, "quoted"'
    assert rows["3"].DEATHS_DIRECT is None and rows["3"].DAMAGE_PROPERTY is None
    assert rows["4"].STATE == "OHIO" and rows["4"].MAGNITUDE is None
    assert sorted(rows["2"].asDict()) == sorted(RAW_EVENTS.fieldNames())


def test_year_filter_prunes_partitions(spark, landed, scratch):
    table = f"{scratch}/raw"
    events.load_events(spark, landed, table, current_year=2000)
    staged = stage_events(spark.read.parquet(table)).filter(~F.col("is_pre_standardization") & (F.col("event_year") < 2000))
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(YEAR" in plan
    assert [r.event_id for r in staged.orderBy("event_id").collect()] == ["2-1999", "3-1999"]


def test_price_series(spark, scratch):
    path = f"{scratch}/cpi.txt"
    rows = [
        ("CUUR0000SA0      ", "1995", "M13", " 152.4"), ("CUUR0000SA0      ", "1996", "M13", " 156.9"),
        ("CUUR0000SA0      ", "1996", "M12", " 158.6"), ("CUUR0000SA0      ", "2000", "M13", " 172.2"),
        ("CUUR0000AA0      ", "2000", "M13", " 99.0"),
    ]
    Path(path).write_text("series_id        \tyear\tperiod\tvalue  \tfootnote_codes\n" + "".join("\t".join(r) + "\t\n" for r in rows))
    averages = prices.annual_averages(prices.read_series(spark, path))
    found = {r.year: r for r in prices.with_deflator(averages, Cutoffs(base_year=2000)).collect()}
    assert set(found) == {1996, 2000}
    assert found[1996].deflator == 172.2 / 156.9 and found[2000].deflator == 1.0
    with pytest.raises(Exception, match="no price index for base year 2024"):
        prices.with_deflator(averages).collect()


def test_census_join(spark, scratch):
    gaz = f"{scratch}/gaz.txt"
    Path(gaz).write_text(
        "USPS\tGEOID\tNAME\tALAND_SQMI           \n"
        "MD\t1\tBaltimore County\t598.3 \nMD\t2\tBaltimore city\t80.9 \nNM\t3\tLea County\t4390.6 \nNM\t4\tBad County\tn/a \n"
    )
    people = f"{scratch}/pop.csv"
    Path(people).write_bytes(
        (
            "SUMLEV,STNAME,CTYNAME,YEAR,AGEGRP,TOT_POP\n"
            "50,Maryland,Baltimore County,13,0,827370\n50,Maryland,Baltimore city,13,0,586131\n"
            "50,New Mexico,Lea County,13,0,70277\n50,New Mexico,Lea County,12,0,1\n50,New Mexico,Lea County,13,1,2\n"
            "40,New Mexico,Lea County,13,0,3\n50,New Mexico,Do\xf1a Ana County,13,0,219561\n50,New Mexico,Bad County,13,0,5\n"
        ).encode("latin-1")
    )
    gazetteer = census.gazetteer_counties(census.read_gazetteer(spark, gaz))
    raw = census.read_population(spark, people)
    population = census.population_counties(raw)
    assert "doña ana" in {r.county_name for r in population.collect()}
    joined = {r.county_name: r for r in census.county_density(population, gazetteer).collect()}
    assert set(joined) == {"baltimore", "lea", "bad"}
    assert joined["lea"].population_density == round(70277 / 4390.6, 4) and joined["bad"].population_density is None
    assert joined["baltimore"].population_2020 == 827370
    report = census.density_match(population, gazetteer).first()
    assert (report.rows, report.matched, report.ok) == (4, 3, False)
    doubled = census.county_density(census.population_counties(raw, keep_cities=True), gazetteer)
    assert doubled.filter("county_name = 'baltimore'").count() == 2


def test_seeds(spark, scratch):
    assert seeds.type_groups(spark).count() == 61 and seeds.type_groups(spark).distinct().count() == 61
    assert seeds.type_groups(spark).select("event_type_group").distinct().count() == 11
    states = seeds.state_regions(spark)
    assert states.count() == 50 and states.select("region").distinct().count() == 6
    assert states.filter("state = 'West Virginia'").first().asDict() == {
        "state": "West Virginia", "state_abbrev": "WV", "region": "SOUTH",
    }
    path = f"{scratch}/seed.csv"
    Path(path).write_text("region,state,state_abbrev\nWEST,Utah,UT\n")
    assert seeds.read_seed(spark, path, STATE_REGIONS).first().asDict() == {
        "state": "Utah", "state_abbrev": "UT", "region": "WEST",
    }
    assert seeds.fixed_rows(spark, [("it's", None)], TYPE_GROUPS).first()[0] == "it's"


def test_intermediates_go_to_the_folder_the_session_names(spark):
    stored = cut_lineage(spark.range(5))
    assert stored.count() == 5 and all("/shared/table-" in path for path in stored.inputFiles())


def test_tables_and_views(spark, scratch):
    frame = spark.range(3)
    warehouse.replace_table(frame, f"{scratch}/t")
    warehouse.replace_table(frame.limit(2), f"{scratch}/t")
    assert warehouse.read_table(spark, f"{scratch}/t").count() == 2
    name = warehouse.register_view(frame, "mart_x", warehouse.MARTS_SCHEMA)
    assert name == "dbt_marts_mart_x" and spark.table(name).count() == 3
    assert warehouse.view_name("stg_x") == "dbt_staging_stg_x"
    stored = warehouse.store_models({"a": frame}, scratch)
    assert stored["a"].count() == 3
