"""Data-quality checks. Each returns its failing rows; the suite counts them."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilscope.operators.joins import orphans
from perilscope.session import cut_lineage
from perilscope.vocab import DEFAULT_CUTOFFS, EVENT_GROUPS, TYPE_GROUP_ROWS, Cutoffs


def not_unique(df: DataFrame, column: str) -> DataFrame:
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") > 1)


def is_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def not_accepted(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """NULL passes."""
    return df.filter(~F.col(column).isin(*accepted))


@dataclass(frozen=True)
class Check:
    """``row_fails`` judges single rows; ``failing`` is for checks that compare rows or tables."""

    model: str
    column: str
    test: str
    row_fails: Column | None = None
    failing: Callable[[dict[str, DataFrame]], DataFrame] | None = None
    reads: tuple[tuple[str, str], ...] = ()  # columns of other models

    def named(self, failures: Column) -> Column:
        return F.struct(
            F.lit(self.model).alias("model"),
            F.lit(self.column).alias("column_name"),
            F.lit(self.test).alias("test"),
            failures.alias("failures"),
            (failures == 0).alias("passed"),
        )


def run_suite(models: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check.

    The checked columns of a model that is read more than once are computed once and stored; all row checks of a model share one
    pass over that narrow table, and the other checks read it too.
    """
    wanted: dict[str, set[str]] = {}
    for check in checks:
        for model, column in ((check.model, check.column), *check.reads):
            wanted.setdefault(model, set()).add(column)
    readings = Counter(model for check in checks if check.failing for model in {check.model, *(name for name, _ in check.reads)})
    readings.update({check.model for check in checks if check.row_fails is not None})
    narrow = {model: models[model].select(*sorted(columns)) for model, columns in wanted.items()}
    models = {model: cut_lineage(df) if readings[model] > 1 else df for model, df in narrow.items()}
    frames = []
    for model, df in models.items():
        mine = [c for c in checks if c.model == model]
        rows = [c.named(F.count_if(c.row_fails)) for c in mine if c.row_fails is not None]
        if rows:
            frames.append(df.agg(F.array(*rows).alias("_r")).select(F.inline("_r")))
        for check in mine:
            if check.failing is not None:
                counted = check.failing(models).agg(check.named(F.count(F.lit(1))).alias("_r"))
                frames.append(counted.select("_r.*"))
    return reduce(DataFrame.unionByName, frames)


def unique(model: str, column: str) -> Check:
    return Check(model, column, "unique", failing=lambda m: not_unique(m[model], column))


def present(model: str, column: str) -> Check:
    return Check(model, column, "not_null", row_fails=F.col(column).isNull())


def accepted(model: str, column: str, values: Sequence[str]) -> Check:
    return Check(model, column, "accepted_values", row_fails=~F.col(column).isin(*values))


def related(model: str, column: str, parent: str, parent_column: str, before: int) -> Check:
    def failing(m: dict[str, DataFrame]) -> DataFrame:
        return orphans(m[model].filter(F.col(column) < before), m[parent], column, parent_column)

    return Check(model, column, "relationships", failing=failing, reads=((parent, parent_column),))


def fan_out_checks() -> list[Check]:
    """Joins with lookups must not multiply events: the key is still unique after the last of them."""
    return [unique("int_events_enriched", "event_id")]


def declared_checks(
    cutoffs: Cutoffs = DEFAULT_CUTOFFS,
    types: Sequence[str] | None = None,
    groups: Sequence[str] = EVENT_GROUPS,
) -> list[Check]:
    """The 24 declared checks: 11 on staging, 13 on the marts."""
    types = types or [name for name, _ in TYPE_GROUP_ROWS]
    stage, cpi = "stg_storm_events", "stg_cpi_deflator"
    severity, risk = "mart_severity_trends", "mart_geographic_risk"
    impact, surprise = "mart_economic_impact", "mart_surprise_states"
    return [
        unique(stage, "event_id"),
        present(stage, "event_id"),
        present(stage, "event_year"),
        related(stage, "event_year", cpi, "cpi_year", cutoffs.partial_year),
        present(stage, "event_type_raw"),
        accepted(stage, "event_type_raw", types),
        present(stage, "deaths_direct"),
        present(stage, "is_pre_standardization"),
        unique(cpi, "cpi_year"),
        present(cpi, "cpi_year"),
        present(cpi, "cpi_deflator"),
        present(severity, "event_year"),
        present(severity, "event_type_group"),
        accepted(severity, "event_type_group", groups),
        present(severity, "event_count"),
        present(risk, "state"),
        present(risk, "decade"),
        unique(impact, "event_type_group"),
        present(impact, "event_type_group"),
        accepted(impact, "event_type_group", groups),
        present(impact, "avg_damage_per_event_2024_usd"),
        present(surprise, "state"),
        present(surprise, "decade"),
        present(surprise, "is_surprise_state"),
    ]
