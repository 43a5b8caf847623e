import datetime as dt

import pytest
from pyspark.sql import functions as F

from perilscope.functions import scalars as fn
from perilscope.functions.damage import damage_rejects, damage_usd


def one(spark, expression, value, kind="string"):
    frame = spark.createDataFrame([(value,)], f"v {kind}")
    return frame.select(expression(F.col("v"))).first()[0]


DAMAGE = [
    (None, None), ("", None), ("   ", None), ("K", None), ("m", None), ("10.00K", 10000.0), ("10.00k", 10000.0),
    ("0T", 0.0), ("5T", 5000.0), ("2.5M", 2.5e6), ("1.5B", 1.5e9), ("500", 500.0), ("0", 0.0), (".5K", 500.0),
    ("1e3", 1000.0), ("10H", None), ("5f", None), ("1.0d", None), ("10K ", None), ("1K0K", 10000.0), ("-2K", -2000.0),
    ("NaN", None), ("Infinity", None), ("1,5K", None),
]


def test_damage_strings(spark):
    frame = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(DAMAGE)], "i int, v string")
    found = {r.i: r.a for r in frame.select("i", damage_usd(F.col("v")).alias("a")).collect()}
    assert [found[i] for i in range(len(DAMAGE))] == [amount for _, amount in DAMAGE]


def test_strict_damage_fails_on_unreadable_text(spark):
    assert one(spark, lambda c: damage_usd(c, strict=True), "500") == 500.0
    assert one(spark, lambda c: damage_usd(c, strict=True), "xK") is None
    with pytest.raises(Exception, match="not a damage amount"):
        one(spark, lambda c: damage_usd(c, strict=True), "10H")


def test_rejects_are_counted(spark):
    frame = spark.createDataFrame([("K",), ("",), (None,), ("5K",), ("10H",)], "d string")
    assert damage_rejects(frame, "d").first().rejected == 2


@pytest.mark.parametrize(
    "text, expected",
    [
        ("28-APR-97 14:45:00", dt.datetime(1997, 4, 28, 14, 45)),
        ("1-jan-05 00:00:01", dt.datetime(2005, 1, 1, 0, 0, 1)),
        ("01-JAN-69 00:00:00", dt.datetime(1969, 1, 1)),
        ("01-JAN-68 00:00:00", dt.datetime(2068, 1, 1)),
        (" 31-DEC-99 23:59:59 ", dt.datetime(1999, 12, 31, 23, 59, 59)),
        ("30-FEB-99 00:00:00", None),
        ("01-JAN-1997 00:00:00", None),
        ("soon", None),
        (None, None),
    ],
)
def test_event_timestamp(spark, text, expected):
    assert one(spark, lambda c: fn.event_timestamp(c).cast("timestamp_ntz"), text) == expected


def test_tiers_and_scale(spark):
    assert [one(spark, fn.damage_tier, v, "double") for v in (None, 0.0, 9999.99, 1e4, 999999.0, 1e6, 1e8)] == [
        "LOW", "LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "CATASTROPHIC",
    ]
    assert [one(spark, fn.fatality_tier, v, "bigint") for v in (0, 1, 2, 3, 10, 11)] == [
        "NONE", "MINOR", "MINOR", "SERIOUS", "SERIOUS", "MASS",
    ]
    assert [one(spark, fn.tornado_scale, v) for v in ("EF3", "f0", "EFU", "", None, " EF5 ", "F-1")] == [
        3, 0, -1, -1, -1, 5, -1,
    ]


def test_names_months_decades(spark):
    names = [" Baltimore County", "Orleans Parish", "X COUNTY", "Juneau City and Borough", "Nome Census Area", "Lake"]
    assert [one(spark, fn.county_key, n) for n in names] == [
        "baltimore", "orleans", "x county", "juneau city and", "nome", "lake",
    ]
    assert [one(spark, fn.month_number, n) for n in ("January", "December", "Smarch", None)] == [1, 12, 0, 0]
    assert [one(spark, fn.decade, y, "bigint") for y in (1996, 2000, 2009, None)] == [1990, 2000, 2000, None]
    assert one(spark, lambda c: fn.event_key(c, F.lit(None)), "7") is None


def test_normal_cdf_is_close(spark):
    import math

    frame = spark.range(-40, 41).select((F.col("id") / 10.0).alias("z"))
    for z, p in frame.select("z", fn.normal_cdf(F.col("z")).alias("p")).collect():
        assert abs(p - 0.5 * math.erfc(-z / math.sqrt(2))) < 1.5e-7
