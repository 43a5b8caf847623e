"""The four marts and the totals other jobs build on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilscope.functions.scalars import exact_total, money, safe_ratio
from perilscope.operators.windows import percent_rank_within, previous_values, ranks_descending, share_of_total
from perilscope.plans.enrich import comparable, grouped_events, located_events
from perilscope.session import cut_lineage
from perilscope.vocab import DEFAULT_CUTOFFS, EVENT_GROUPS, Cutoffs

# Groups that can be named as dominant, in tie order; any other winner is reported as the fallback.
DOMINANT_ORDER = ("TORNADO", "FLOOD", "WIND", "HURRICANE")
DOMINANT_FALLBACK = "WINTER_STORM"


def _measures(keys: list[str], events: DataFrame, extra: list[Column]) -> DataFrame:
    """One partial-then-final aggregation; money is summed as exact decimals."""
    return events.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("deaths_direct").alias("deaths"),
        F.sum("injuries_direct").alias("injuries"),
        money(exact_total(F.col("total_damage_2024_usd"))).alias("real"),
        *extra,
    )


def _component(name: str) -> Column:
    return money(exact_total(F.coalesce(F.col(name), F.lit(0.0))))


def severity_trends(enriched: DataFrame, cutoffs: Cutoffs = DEFAULT_CUTOFFS) -> DataFrame:
    """Frequency and severity per (year, type group)."""
    nominal = money(exact_total(F.col("total_damage_usd"))).alias("nominal")
    totals = _measures(["event_year", "event_type_group"], grouped_events(enriched, cutoffs), [nominal])
    deaths_per_event = F.round(safe_ratio(F.col("deaths"), F.col("n")), 4)
    return totals.select(
        "event_year",
        "event_type_group",
        F.col("n").alias("event_count"),
        F.col("deaths").alias("total_deaths_direct"),
        F.col("injuries").alias("total_injuries_direct"),
        deaths_per_event.alias("avg_deaths_per_event"),
        F.col("nominal").alias("total_damage_usd"),
        F.col("real").alias("total_damage_2024_usd"),
        F.round(safe_ratio(F.col("real"), F.col("n")), 2).alias("avg_damage_per_event_2024_usd"),
        deaths_per_event.alias("fatality_rate_per_event"),
    )


def group_counts(group: Column) -> list[Column]:
    """Conditional count per known type group, each computed once."""
    return [F.count_if(group == g).alias(f"n_{g}") for g in EVENT_GROUPS]


def dominant_group(mode: str = "compat") -> Column:
    """Most frequent group from the conditional counts.

    ``compat``: only the four named groups or the fallback can win, earlier names win ties.
    ``exact``: the true mode over all groups; NULL when nothing is grouped.
    """
    best = F.greatest(*[F.col(f"n_{g}") for g in EVENT_GROUPS])
    named = F.lit(None).cast("string")
    if mode == "exact":
        order = [*DOMINANT_ORDER, *[g for g in EVENT_GROUPS if g not in DOMINANT_ORDER]]
        for g in reversed(order):
            named = F.when(F.col(f"n_{g}") == best, g).otherwise(named)
        return F.when(best > 0, named)
    named = F.lit(DOMINANT_FALLBACK)
    for g in reversed(DOMINANT_ORDER):
        named = F.when(F.col(f"n_{g}") == best, g).otherwise(named)
    return named


def geographic_risk(enriched: DataFrame, cutoffs: Cutoffs = DEFAULT_CUTOFFS, mode: str = "compat") -> DataFrame:
    """Risk per (state, region, decade) with the state's damage percentile inside its decade."""
    totals = _measures(
        ["state", "region", "decade"],
        located_events(enriched, cutoffs),
        [
            _component("property_damage_2024_usd").alias("property"),
            _component("crop_damage_2024_usd").alias("crop"),
            *group_counts(F.col("event_type_group")),
        ],
    )
    risk = totals.select(
        "state",
        "region",
        "decade",
        F.col("n").alias("event_count"),
        F.col("deaths").alias("total_deaths_direct"),
        F.col("injuries").alias("total_injuries_direct"),
        F.col("real").alias("total_damage_2024_usd"),
        F.col("property").alias("property_damage_2024_usd"),
        F.col("crop").alias("crop_damage_2024_usd"),
        F.round(safe_ratio(F.col("real"), F.col("n")), 2).alias("avg_damage_per_event_2024_usd"),
        dominant_group(mode).alias("dominant_event_type"),
    )
    return percent_rank_within(risk, ["decade"], "total_damage_2024_usd", "damage_percentile_in_decade")


def economic_impact(enriched: DataFrame, cutoffs: Cutoffs = DEFAULT_CUTOFFS) -> DataFrame:
    """Cost per type group with share of the total and two ranks."""
    totals = _measures(
        ["event_type_group"],
        grouped_events(enriched, cutoffs),
        [
            _component("property_damage_2024_usd").alias("property"),
            _component("crop_damage_2024_usd").alias("crop"),
            money(exact_total(F.col("total_damage_usd"))).alias("nominal"),
        ],
    )
    impact = totals.select(
        "event_type_group",
        F.col("n").alias("total_events"),
        F.col("real").alias("total_damage_2024_usd"),
        F.col("property").alias("total_property_damage_2024_usd"),
        F.col("crop").alias("total_crop_damage_2024_usd"),
        F.col("nominal").alias("total_damage_usd_nominal"),
        F.round(safe_ratio(F.col("real"), F.col("n")), 2).alias("avg_damage_per_event_2024_usd"),
        F.col("deaths").alias("total_deaths_direct"),
        F.col("injuries").alias("total_injuries_direct"),
        F.round(safe_ratio(F.col("deaths"), F.col("n")), 4).alias("avg_deaths_per_event"),
    )
    impact = share_of_total(impact, F.col("total_damage_2024_usd"), "pct_of_total_damage")
    return ranks_descending(
        impact,
        {
            "avg_damage_per_event_2024_usd": "rank_by_damage_per_event",
            "total_damage_2024_usd": "rank_by_total_damage",
        },
    )


def surprise_states(risk: DataFrame, jump: float = 20.0) -> DataFrame:
    """Decade-over-decade change of each state's damage and percentile; first decades are left out."""
    now = F.col("total_damage_2024_usd")
    before = F.col("prior_decade_damage_2024_usd")
    shift = F.col("damage_percentile_in_decade") - F.col("prior_decade_damage_percentile")
    lagged = previous_values(
        risk,
        ["state"],
        "decade",
        {
            "total_damage_2024_usd": "prior_decade_damage_2024_usd",
            "event_count": "prior_decade_event_count",
            "damage_percentile_in_decade": "prior_decade_damage_percentile",
        },
    )
    return lagged.filter(before.isNotNull()).select(
        "state",
        "region",
        "decade",
        "event_count",
        "total_damage_2024_usd",
        "total_deaths_direct",
        "damage_percentile_in_decade",
        "prior_decade_damage_2024_usd",
        "prior_decade_event_count",
        "prior_decade_damage_percentile",
        F.round(now - before, 2).alias("damage_delta_2024_usd"),
        F.round(F.try_divide(now - before, F.nullif(before, F.lit(0.0))) * 100, 2).alias("damage_pct_change"),
        F.round(shift, 1).alias("percentile_rank_change"),
        (shift > F.lit(jump)).alias("is_surprise_state"),
    )


MART_INPUTS = (
    "event_year", "event_type_group", "state", "region", "decade", "is_pre_standardization", "deaths_direct",
    "injuries_direct", "property_damage_2024_usd", "crop_damage_2024_usd", "total_damage_usd",
    "total_damage_2024_usd",
)


def mart_base(enriched: DataFrame, cutoffs: Cutoffs = DEFAULT_CUTOFFS) -> DataFrame:
    """The few columns of comparable events that the marts read, stored once: every mart scans that narrow table."""
    return cut_lineage(comparable(enriched, cutoffs).select(*MART_INPUTS))


def build_marts(enriched: DataFrame, cutoffs: Cutoffs = DEFAULT_CUTOFFS) -> dict[str, DataFrame]:
    """All four marts from one pass over the events: three aggregations of ``mart_base``; the fourth mart reads the stored
    geographic one."""
    base = mart_base(enriched, cutoffs)
    risk = cut_lineage(geographic_risk(base, cutoffs))
    return {
        "mart_severity_trends": severity_trends(base, cutoffs),
        "mart_geographic_risk": risk,
        "mart_economic_impact": economic_impact(base, cutoffs),
        "mart_surprise_states": surprise_states(risk),
    }


def yearly_totals(severity: DataFrame) -> DataFrame:
    """Severity mart rolled up to years."""
    real = money(F.sum(F.col("total_damage_2024_usd").cast("decimal(30,2)")))
    totals = severity.groupBy("event_year").agg(
        F.sum("event_count").alias("total_events"),
        real.alias("total_damage"),
        F.sum("total_deaths_direct").alias("total_deaths"),
    )
    return totals.withColumn("avg_damage_per_event", safe_ratio(F.col("total_damage"), F.col("total_events")))


def state_year_totals(enriched: DataFrame, cutoffs: Cutoffs = DEFAULT_CUTOFFS) -> DataFrame:
    """Events, deaths and damage per (state, year), from all located events."""
    return (
        located_events(enriched, cutoffs)
        .groupBy("state", "event_year")
        .agg(
            F.count(F.lit(1)).alias("state_year_event_count"),
            F.sum("deaths_direct").alias("state_year_deaths"),
            money(exact_total(F.col("total_damage_2024_usd"))).alias("state_year_damage"),
        )
    )


def state_year_lags(totals: DataFrame) -> DataFrame:
    """Each state's totals of the previous year that has any."""
    lagged = previous_values(
        totals,
        ["state"],
        "event_year",
        {
            "state_year_event_count": "lag_event_count",
            "state_year_deaths": "lag_deaths",
            "state_year_damage": "lag_damage",
        },
    )
    return lagged.select("state", "event_year", "lag_event_count", "lag_deaths", "lag_damage")


def ordered_for_reading(df: DataFrame, *order: Column | str) -> DataFrame:
    """Presentation order. Tables are written unsorted."""
    return df.orderBy(*order)
