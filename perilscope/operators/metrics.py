"""Classifier evaluation as aggregations. Every function takes optional grouping keys, so many models or
feature variants are evaluated in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perilscope.functions.scalars import safe_ratio
from perilscope.operators.prefix import running_sums
from perilscope.session import cut_lineage


def score_counts(df: DataFrame, score: str, label: str, keys: Sequence[str] = (), copies: str | None = None) -> DataFrame:
    """Positives and negatives per distinct score: all a curve needs to know about the rows. ``copies``: a row stands for so many."""
    rows = F.col(copies) if copies else F.lit(1).cast("bigint")
    of_class = {"pos": F.col(label) == 1, "neg": F.col(label) == 0}
    return df.groupBy(*keys, F.col(score).alias("score")).agg(
        *[F.sum(F.when(hit, rows).otherwise(0)).alias(out) for out, hit in of_class.items()]
    )


def curve_of_counts(counted: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``pos``/``neg`` belong to the score itself, ``tp``/``fp`` include all higher scores."""
    keys = list(keys)
    summed = running_sums(counted, keys, "score", {"tp": F.col("pos"), "fp": F.col("neg")}, descending=True)
    totals = counted.groupBy(*keys).agg(F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))
    if keys:
        joined = summed.join(totals, keys)
    else:
        joined = summed.withColumns({c: totals.select(c).scalar() for c in ("positives", "negatives")})
    return joined.withColumns(
        {
            "precision": safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")),
            "recall": safe_ratio(F.col("tp"), F.col("positives")),
            "fpr": safe_ratio(F.col("fp"), F.col("negatives")),
        }
    )


def curve(df: DataFrame, score: str, label: str, keys: Sequence[str] = (), copies: str | None = None) -> DataFrame:
    """Exact precision/recall/false-positive points, one per distinct score.

    Rows are scored and merged once; everything after that reads the stored counts.
    """
    return curve_of_counts(cut_lineage(score_counts(df, score, label, keys, copies)), keys)


def areas(points: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Step-wise average precision, trapezoid PR area and ROC area. The previous point of a score follows
    from its own counts, so no row needs its neighbour."""
    before_tp = F.col("tp") - F.col("pos")
    before_fp = F.col("fp") - F.col("neg")
    before_precision = F.coalesce(safe_ratio(before_tp, before_tp + before_fp), F.lit(1.0))
    gained = safe_ratio(F.col("pos"), F.col("positives"))
    wrong = safe_ratio(F.col("neg"), F.col("negatives"))
    height = safe_ratio(before_tp + F.col("tp"), 2 * F.col("positives"))
    return points.groupBy(*keys).agg(
        F.sum(gained * F.col("precision")).alias("average_precision"),
        F.sum(gained * (before_precision + F.col("precision")) / 2).alias("pr_auc_trapezoid"),
        F.sum(wrong * height).alias("roc_auc"),
    )


def f1(precision: Column, recall: Column) -> Column:
    return 2 * precision * recall / (precision + recall + F.lit(1e-9))


def thresholds(
    points: DataFrame,
    keys: Sequence[str] = (),
    precision_floor: float = 0.05,
    recall_floor: float = 0.5,
    high_precision: float = 0.10,
) -> DataFrame:
    """Candidate cut-offs: most recall at a precision floor, best F1, highest cut-off that still reaches a
    recall, lowest one that reaches a precision. NULL where no point qualifies, except the first, which then
    falls back to full recall."""
    score, precision, recall = F.col("score"), F.col("precision"), F.col("recall")
    floor = F.min(F.when(precision >= precision_floor, score))
    best = F.max(F.struct(f1(precision, recall).alias("f1"), (-score).alias("minus")))
    return points.groupBy(*keys).agg(
        F.coalesce(floor, F.min(score)).alias("max_recall_threshold"),
        F.max(F.when(precision >= precision_floor, recall)).alias("recall_at_floor"),
        (-best["minus"]).alias("max_f1_threshold"),
        best["f1"].alias("max_f1"),
        F.max(F.when(recall >= recall_floor, score)).alias("recall_threshold"),
        F.min(F.when(precision >= high_precision, score)).alias("precision_threshold"),
    )


def compare(df: DataFrame, scores: Sequence[str], label: str, digits: int = 4, copies: str | None = None) -> DataFrame:
    """One row per score column: areas, chosen cut-off and its recall. All models share one job."""
    kept = [label, copies] if copies else [label]
    long = df.select(*kept, *scores).unpivot(kept, list(scores), "model", "score")
    points = curve(long, "score", label, ["model"], copies)
    table = areas(points, ["model"]).join(thresholds(points, ["model"]), "model")
    return table.select(
        "model",
        F.round("average_precision", digits).alias("pr_auc"),
        F.round("roc_auc", digits).alias("roc_auc"),
        F.round("max_recall_threshold", 2).alias("best_threshold"),
        F.round(F.coalesce("recall_at_floor", F.lit(1.0)), 3).alias("recall_at_threshold"),
    )


def blend(df: DataFrame, blends: dict[str, dict[str, float]]) -> DataFrame:
    """Weighted sums of score columns."""

    def mixed(weights: dict[str, float]) -> Column:
        total = None
        for name, weight in weights.items():
            part = F.lit(float(weight)) * F.col(name)
            total = part if total is None else total + part
        return total

    return df.withColumns({out: mixed(weights) for out, weights in blends.items()})


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Counts and share of the true class, long form."""
    counts = df.groupBy(F.col(label).alias("actual"), F.col(predicted).alias("predicted"))
    counts = counts.agg(F.count(F.lit(1)).alias("n"))
    of_class = F.sum("n").over(Window.partitionBy("actual"))
    return counts.withColumn("support", of_class).filter(F.col("actual").isNotNull()).select(
        "actual", "predicted", "n", F.round(safe_ratio(F.col("n"), F.col("support")), 6).alias("share")
    )


def confusion_matrix(df: DataFrame, label: str, predicted: str, classes: Sequence) -> DataFrame:
    """Row-normalised matrix, one column per predicted class."""
    hits = [F.count_if(F.col(predicted) == c) for c in classes]
    shares = [F.round(safe_ratio(hit, F.count(F.lit(1))), 6).alias(f"predicted_{c}") for hit, c in zip(hits, classes)]
    return df.groupBy(F.col(label).alias("actual")).agg(*shares)


def report(df: DataFrame, label: str, predicted: str, digits: int = 6) -> DataFrame:
    """Precision, recall, F1 and support per class, with the macro F1 on every row."""
    counts = df.groupBy(label, predicted).agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col(label) == F.col(predicted), F.col("n")).otherwise(0)
    actual = counts.groupBy(F.col(label).alias("class")).agg(F.sum("n").alias("support"), F.sum(hit).alias("hits"))
    called = counts.groupBy(F.col(predicted).alias("class")).agg(F.sum("n").alias("called"))
    table = actual.join(called, "class", "full").fillna(0, ["support", "hits", "called"])
    precision = F.coalesce(safe_ratio(F.col("hits"), F.col("called")), F.lit(0.0))
    recall = F.coalesce(safe_ratio(F.col("hits"), F.col("support")), F.lit(0.0))
    score = F.coalesce(safe_ratio(2 * F.col("hits"), F.col("called") + F.col("support")), F.lit(0.0))
    table = table.select("class", "support", precision.alias("p"), recall.alias("r"), score.alias("f"))
    macro = table.agg(F.avg("f")).scalar()
    return table.select(
        "class",
        F.round("p", digits).alias("precision"),
        F.round("r", digits).alias("recall"),
        F.round("f", digits).alias("f1"),
        "support",
        F.round(macro, digits).alias("macro_f1"),
    )


def reliability(df: DataFrame, score: str, label: str, bins: int = 10, digits: int = 6) -> DataFrame:
    """Mean score and positive rate per uniform bin; empty bins do not appear."""
    place = F.least(F.greatest(F.ceil(F.col(score) * bins) - 1, F.lit(0)), F.lit(bins - 1)).cast("int")
    return df.groupBy(place.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(score), digits).alias("mean_score"),
        F.round(F.avg(F.col(label).cast("double")), digits).alias("positive_rate"),
    )


def funnel(df: DataFrame, fatal: Column, flagged: Column, critical: Column, called: Column, per: int = 10_000) -> DataFrame:
    """What a two-stage screen does to ``per`` events: flagged, caught, false alarms, critical ones caught."""
    one = F.lit(1)
    base = df.agg(
        F.count(one).alias("events"),
        F.count_if(fatal).alias("fatal"),
        F.count_if(flagged).alias("flagged"),
        F.count_if(flagged & fatal).alias("caught"),
        F.count_if(flagged & critical).alias("critical_flagged"),
        F.count_if(flagged & critical & called).alias("critical_called"),
    )
    rate = safe_ratio(F.col("fatal"), F.col("events"))
    recall = safe_ratio(F.col("caught"), F.col("fatal"))
    critical_recall = safe_ratio(F.col("critical_called"), F.col("critical_flagged"))
    return (
        base.withColumn("true_fatal", F.round(per * rate))
        .withColumn("flagged_for_review", F.round(per * safe_ratio(F.col("flagged"), F.col("events"))))
        .withColumn("fatal_surfaced", F.round(F.col("true_fatal") * recall))
        .withColumn("false_alarms", F.col("flagged_for_review") - F.col("fatal_surfaced"))
        .withColumn("critical_alerts", F.round(F.col("fatal_surfaced") * critical_recall))
    )
