"""Scalar column functions: text, dates, numbers and tiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from perilscope.vocab import COUNTY_SUFFIXES, MONTHS

# Two-digit years from this one on belong to the twentieth century.
CENTURY_PIVOT = 69

EVENT_TIME = "d-MMM-yyyy HH:mm:ss"
# The usual shape of a time, which a cast reads many times faster than a pattern.
PLAIN_TIME = r"^[0-9]{2}-[A-Za-z]{3}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"
SHORT_MONTHS = "".join(f"{month[:3].upper()}{number:02d}" for number, month in enumerate(MONTHS, 1))


def event_key(event_id: Column, year: Column) -> Column:
    """Surrogate key; NULL when either part is."""
    return F.concat(event_id.cast("string"), F.lit("-"), year.cast("string"))


def event_timestamp(text: Column, strict: bool = False) -> Column:
    """``28-APR-97 14:45:00`` as a timestamp, two-digit years read as 1969-2068.

    Texts of the usual shape are put in ISO order by position and cast; the pattern reads the others.
    """
    year, dash = F.substring(text, 8, 2), F.lit("-")
    place = F.instr(F.lit(SHORT_MONTHS), F.upper(F.substring(text, 4, 3)))
    number = F.substring(F.lit(SHORT_MONTHS), place + 3, 2)
    iso = F.concat(_century(year), year, dash, number, dash, F.substring(text, 1, 2), F.substring(text, 10, 9))
    plain = F.when(text.rlike(PLAIN_TIME), iso.try_cast("timestamp"))
    day, month, rest = (F.split_part(F.trim(text), dash, F.lit(i)) for i in (1, 2, 3))
    full = F.concat(day, dash, month, dash, _century(rest), rest)
    return F.coalesce(plain, F.to_timestamp(full, EVENT_TIME) if strict else F.try_to_timestamp(full, F.lit(EVENT_TIME)))


def _century(year: Column) -> Column:
    return F.when(year >= F.lit(str(CENTURY_PIVOT)), F.lit("19")).otherwise(F.lit("20"))


def decade(year: Column) -> Column:
    return (F.floor(year / F.lit(10)) * F.lit(10)).cast("bigint")


def county_key(name: Column, suffixes: Sequence[str] = COUNTY_SUFFIXES) -> Column:
    """County name without its kind, lower case. The suffix match is case-sensitive and precedes lower()."""
    pattern = r"\s+(" + "|".join(suffixes) + r")$"
    return F.lower(F.trim(F.regexp_replace(F.trim(name), pattern, "")))


def month_number(name: Column) -> Column:
    """January..December as 1..12; anything else as 0."""
    table = F.create_map(*[part for i, m in enumerate(MONTHS, 1) for part in (F.lit(m), F.lit(i))])
    return F.coalesce(F.try_element_at(table, name), F.lit(0))


def lookup(key: Column, table: dict, default=None) -> Column:
    """Literal dictionary lookup for small fixed tables."""
    if not table:
        return F.lit(default)
    literal = F.create_map(*[part for k, v in table.items() for part in (F.lit(k), F.lit(v))])
    found = F.try_element_at(literal, key)
    return found if default is None else F.coalesce(found, F.lit(default))


def tornado_scale(text: Column) -> Column:
    """``EF3`` / ``F3`` as 3; missing or unreadable as -1."""
    digits = F.trim(F.replace(F.replace(F.upper(text), F.lit("EF"), F.lit("")), F.lit("F"), F.lit("")))
    return F.coalesce(F.when(digits.rlike(r"^[+-]?\d+$"), digits.try_cast("int")), F.lit(-1))


def damage_tier(amount: Column) -> Column:
    return (
        F.when(amount.isNull() | (amount < 10_000), "LOW")
        .when(amount < 1_000_000, "MEDIUM")
        .when(amount < 100_000_000, "HIGH")
        .otherwise("CATASTROPHIC")
    )


def fatality_tier(deaths: Column) -> Column:
    return (
        F.when(deaths == 0, "NONE").when(deaths <= 2, "MINOR").when(deaths <= 10, "SERIOUS").otherwise("MASS")
    )


def safe_ratio(top: Column, bottom: Column) -> Column:
    """NULL instead of an error when the divisor is 0 or NULL."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def exact_total(amount: Column) -> Column:
    """Sum of money rounded to cents per row, independent of row order and partitioning."""
    return F.sum(amount.cast("decimal(20,2)"))


def money(total: Column) -> Column:
    return total.cast("double")


def scaled(amount: Column, unit: float, digits: int) -> Column:
    return F.round(amount / F.lit(float(unit)), digits)


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function, Abramowitz & Stegun 7.1.26 (|error| < 1.5e-7)."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1.0 / (1.0 + 0.3275911 * x)
    series = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    erf = 1.0 - series * F.exp(-x * x)
    return F.when(z >= 0, 0.5 * (1.0 + erf)).otherwise(0.5 * (1.0 - erf))


def hash_fraction(*parts: Column) -> Column:
    """Repeatable pseudo-random number in [0, 1) from row values."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 53)).cast("double") / F.lit(float(1 << 53))
