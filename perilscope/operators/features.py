"""Model features as plain columns: labels, one-hot, lags, encodings, weights, imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perilscope.functions.scalars import lookup, month_number, safe_ratio, tornado_scale
from perilscope.operators.prefix import quantile_value
from perilscope.vocab import EVENT_GROUPS, REGIONS

LAGS = ("lag_event_count", "lag_deaths", "lag_damage")
CALENDAR = ("decade", "event_month")
MAGNITUDE_SENTINEL = -1.0
DANGER_RANGE = 4.0


def fatal_label(deaths: Column) -> Column:
    return (deaths > 0).cast("double")


def attach_lags(events: DataFrame, lags: DataFrame) -> DataFrame:
    """Previous-year totals of the event's state; 0 where there are none. AQE broadcasts the totals once it knows their size."""
    joined = events.join(lags.select("state", "event_year", *LAGS), ["state", "event_year"], "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in LAGS})


def one_hot_names(column: str, vocabulary: Sequence[str]) -> list[str]:
    return [f"{column}_{value}".replace(" ", "_") for value in vocabulary]


def one_hot(df: DataFrame, column: str, vocabulary: Sequence[str]) -> DataFrame:
    """One 0/1 column per known value; NULL and unknown values are all zero."""
    names = one_hot_names(column, vocabulary)
    return df.withColumns(
        {name: F.when(F.col(column) == value, 1.0).otherwise(0.0) for name, value in zip(names, vocabulary)}
    )


def feature_names(
    numeric: Sequence[str] = (*CALENDAR, *LAGS),
    groups: Sequence[str] = EVENT_GROUPS,
    regions: Sequence[str] = REGIONS,
) -> list[str]:
    return [*numeric, *one_hot_names("event_type_group", groups), *one_hot_names("region", regions)]


def align(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Feature columns in the given order; absent ones are 0."""
    present = set(df.columns)
    return df.select(
        *keep, *[F.col(c).cast("double").alias(c) if c in present else F.lit(0.0).alias(c) for c in names]
    )


def assemble(df: DataFrame, names: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(names), outputCol=out).transform(df)


def split_by_year(df: DataFrame, last_train_year: int, year: str = "event_year") -> tuple[DataFrame, DataFrame]:
    """Train up to and including the year, test strictly after it."""
    return df.filter(F.col(year) <= last_train_year), df.filter(F.col(year) > last_train_year)


def label_summary(df: DataFrame, label: str, categories: Sequence[str] = ()) -> DataFrame:
    """One row: n, neg and pos (rows by label), classes (label to rows) and, per category, of_ (a map of value to rows and
    positives), low_ and high_ (the extreme rates of its values).

    One aggregation over grouping sets counts all of it in one scan. Categories are columns of a vocabulary: the row grows
    with the vocabularies, not with the data.
    """
    columns = [label, *categories]
    sets = [[], *[[c] for c in columns]]
    counts = {"_n": F.count(F.lit(1)), "_neg": F.count_if(F.col(label) == 0), "_pos": F.count_if(F.col(label) == 1)}
    kept = df.select(*columns).withColumns({f"_k{k}": F.col(c) for k, c in enumerate(columns)})
    keys = [f"_k{k}" for k in range(len(columns))]
    cells = kept.groupingSets([[f"_k{columns.index(c)}" for c in one] for one in sets], *keys).agg(
        *[value.alias(out) for out, value in counts.items()], F.grouping_id().alias("_set")
    )
    everything = (1 << len(columns)) - 1  # a bit per column that is not in the set, the first column highest
    whole = F.col("_set") == everything

    def only(k: int, value: Column) -> Column:
        here = (F.col("_set") == everything - (1 << (len(columns) - 1 - k))) & F.col(f"_k{k}").isNotNull()
        return F.map_from_entries(F.collect_list(F.when(here, F.struct(F.col(f"_k{k}"), value))))

    of_category = F.struct(F.col("_n").alias("n"), F.col("_pos").alias("pos"))
    summary = cells.agg(
        *[F.max(F.when(whole, F.col(c))).alias(out) for c, out in (("_n", "n"), ("_neg", "neg"), ("_pos", "pos"))],
        only(0, F.col("_n")).alias("classes"),
        *[only(k + 1, of_category).alias(f"of_{c}") for k, c in enumerate(categories)],
    )
    for c in categories:
        rates = F.transform(F.map_values(f"of_{c}"), _rate)
        summary = summary.withColumns({f"low_{c}": F.array_min(rates), f"high_{c}": F.array_max(rates)})
    return summary


def known(summary: DataFrame, now: bool = False) -> Column:
    """The row of a summary as one column: computed by the query that uses it, or ``now``, once for many queries."""
    row = summary.select(F.struct("*").alias("known"))
    if not now:
        return row.scalar()
    return _literal(row.first()["known"], row.schema["known"].dataType)


def _literal(value, kind: T.DataType) -> Column:
    """A collected value as a constant column of its type."""
    if isinstance(kind, T.StructType) and value is not None:
        return F.struct(*[_literal(value[field.name], field.dataType).alias(field.name) for field in kind])
    if isinstance(kind, T.MapType) and value is not None:
        pairs = [_literal(*part) for k, v in value.items() for part in ((k, kind.keyType), (v, kind.valueType))]
        return F.create_map(*pairs).cast(kind)
    return F.lit(value).cast(kind)


def _rate(cell: Column) -> Column:
    return safe_ratio(cell["pos"], cell["n"])


def balanced_weights(df: DataFrame, label: str, out: str = "weight", seen: Column | None = None) -> DataFrame:
    """n / (classes x class size). ``seen``: what is ``known`` of the rows that count, these rows by default."""
    seen = known(label_summary(df, label)) if seen is None else seen
    size = F.try_element_at(seen["classes"], F.col(label))
    return df.withColumn(out, safe_ratio(seen["n"], F.size(F.map_keys(seen["classes"])) * size))


def positive_weights(df: DataFrame, label: str, out: str = "weight", seen: Column | None = None) -> DataFrame:
    """Positives weigh as much as all negatives together."""
    seen = known(label_summary(df, label)) if seen is None else seen
    return df.withColumn(out, F.when(F.col(label) == 1, safe_ratio(seen["neg"], seen["pos"])).otherwise(1.0))


def danger_weights(df: DataFrame, category: str, label: str, out: str = "weight", seen: Column | None = None) -> DataFrame:
    """Positives: odds against the label, times 1 to 5 by the category's own rate. Negatives: 1."""
    seen = known(label_summary(df, label, [category])) if seen is None else seen
    share = safe_ratio(seen["pos"], seen["n"])
    low, high = seen[f"low_{category}"], seen[f"high_{category}"]
    spread = F.try_divide(_rate(F.try_element_at(seen[f"of_{category}"], F.col(category))) - low, high - low)
    positive = F.try_divide(1 - share, share) * F.coalesce(1 + DANGER_RANGE * spread, F.lit(1.0))
    return df.withColumn(out, F.when(F.col(label) == 1, positive).otherwise(1.0))


def target_encode(train: DataFrame, df: DataFrame, columns: dict[str, str], label: str, seen: Column | None = None) -> DataFrame:
    """Training rate per category value; values unseen in training get the overall rate."""
    seen = known(label_summary(train, label, list(columns))) if seen is None else seen
    overall = safe_ratio(seen["pos"], seen["n"])
    rates = {out: _rate(F.try_element_at(seen[f"of_{c}"], F.col(c))) for c, out in columns.items()}
    return df.withColumns({out: F.coalesce(rate, overall) for out, rate in rates.items()})


def impute(df: DataFrame, density_median: float | None = None) -> DataFrame:
    """Median density, scale -1, month 0; missing magnitude becomes a sentinel below its range plus a flag."""
    median = density_median if density_median is not None else quantile_value(df, "population_density", 0.5)
    return df.withColumns(
        {
            "fscale_num": tornado_scale(F.col("tornado_f_scale")),
            "month_num": month_number(F.col("event_month")),
            "population_density": F.coalesce("population_density", F.lit(median)),
            "magnitude_missing": F.col("magnitude").isNull().cast("int"),
            "magnitude": F.coalesce("magnitude", F.lit(MAGNITUDE_SENTINEL)),
        }
    )


def class_codes(tiers: Sequence[str]) -> dict[str, int]:
    """Class numbers in alphabetical order."""
    return {tier: i for i, tier in enumerate(sorted(tiers))}


def encode_class(tier: Column, tiers: Sequence[str]) -> Column:
    return lookup(tier, class_codes(tiers)).cast("double")
