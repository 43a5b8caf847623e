"""Model fitting and scoring with Spark ML: logistic, boosted trees, tiers, two stages, calibration."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    OneVsRest,
    OneVsRestModel,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perilscope.functions.scalars import safe_ratio
from perilscope.operators import boosting
from perilscope.operators.scaling import Scaling, scaling_stage

FEATURES = "features"
SCALED = "__scaled"


def fit_logistic(
    train: DataFrame, label: str, weight: str | None = None, rounds: int = 200, strength: float = 1.0, copies: str | None = None
):
    """L2 penalty ``1/C`` on the summed loss, which on Spark's averaged loss is 1 / (C x total weight). ``copies``: a row stands for so many."""
    if copies:
        train = train.withColumn("__weight", (F.col(weight) if weight else F.lit(1.0)) * F.col(copies))
        weight = "__weight"
    total = train.agg(F.sum(weight) if weight else F.count(F.lit(1))).first()[0]
    learner = LogisticRegression(
        featuresCol=FEATURES,
        labelCol=label,
        maxIter=rounds,
        elasticNetParam=0.0,
        regParam=1.0 / (strength * float(total)),
        standardization=False,
    )
    return (learner.setWeightCol(weight) if weight else learner).fit(train)


def boosted(label: str, weight: str | None, rounds: int, depth: int, step: float, seed: int) -> GBTClassifier:
    learner = GBTClassifier(
        featuresCol=FEATURES,
        labelCol=label,
        maxIter=rounds,
        maxDepth=depth,
        stepSize=step,
        subsamplingRate=0.8,
        seed=seed,
    )
    return learner.setWeightCol(weight) if weight else learner


def fit_boosted(
    train: DataFrame,
    label: str,
    weight: str | None = None,
    rounds: int = 100,
    depth: int = 4,
    step: float = 0.1,
    seed: int = 42,
    copies: str | None = None,
    counted: bool = False,
) -> GBTClassificationModel:
    """``counted``: grown on counted cells, for many rounds or rows; the draws are then others. ``copies``: a row stands for so many."""
    learner = boosted(label, weight, rounds, depth, step, seed)
    if not (counted or copies):
        return learner.fit(train)
    return boosting.fit(train.withColumn(label, boosting.binary_label(label)), learner, [1.0], weight, copies)[0]


def fit_tiers(
    train: DataFrame, label: str, weight: str, rounds: int = 200, depth: int = 5, step: float = 0.05, seed: int = 42
):
    """Several ordered classes: one weighted boosted model per class. The trees of all classes grow together."""
    base = boosted(label, weight, rounds, depth, step, seed)
    most = train.agg(F.max(label)).first()[0]
    models = boosting.fit(train, base, [float(k) for k in range(int(most) + 1)], weight)
    several = OneVsRest(featuresCol=FEATURES, labelCol=label, weightCol=weight, classifier=base)
    return several._copyValues(OneVsRestModel(models=models))


def with_score(model: Transformer, df: DataFrame, out: str) -> DataFrame:
    """Probability of class 1 as a plain column; nothing else is added."""
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(out))


def with_class(model: Transformer, df: DataFrame, out: str) -> DataFrame:
    """The class of largest margin among several models, the first one of equals; else what the model predicts."""
    if not isinstance(model, OneVsRestModel):
        return model.transform(df).select(*df.columns, F.col("prediction").alias(out))
    scored, margins = df, []
    for k, one in enumerate(model.models):
        margins.append(f"__margin_{k}")
        scored = one.copy({one.rawPredictionCol: margins[-1], one.predictionCol: "", one.probabilityCol: ""}).transform(scored)
    sides = F.array(*[vector_to_array(c)[1] for c in margins])
    return scored.select(*df.columns, (F.array_position(sides, F.array_max(sides)) - 1).cast("double").alias(out))


@dataclass
class TwoStage:
    """Any-death screen, then minor/critical among those the screen flags."""

    first: Transformer
    second: Transformer
    first_threshold: float
    second_threshold: float

    def apply(self, df: DataFrame) -> DataFrame:
        """Adds p1, flagged, p2 and called; p2 is only meant for flagged rows and NULL elsewhere."""
        scored = with_score(self.second, with_score(self.first, df, "p1"), "_p2")
        flagged = F.col("p1") >= self.first_threshold
        return (
            scored.withColumn("flagged", flagged)
            .withColumn("p2", F.when(flagged, F.col("_p2")))
            .withColumn("called", F.coalesce(F.col("p2") >= self.second_threshold, F.lit(False)))
            .drop("_p2")
        )


def fit_calibration(held_out: DataFrame, score: str, label: str, copies: str | None = None) -> IsotonicRegressionModel:
    """Isotonic map from score to frequency, fitted on rows kept out of training.

    Rows of equal score are merged first; the learner then pools neighbours inside each partition before the last
    pass, so what meets in one place are pools, not rows.
    """
    y, n = F.col(label).cast("double"), F.col(copies) if copies else F.lit(1).cast("bigint")
    share = F.sum(y * n) / F.sum(F.when(y.isNotNull(), n))
    merged = held_out.groupBy(F.col(score).alias("_s")).agg(share.alias("_y"), F.sum(n).cast("double").alias("_w"))
    learner = IsotonicRegression(featuresCol="_s", labelCol="_y", weightCol="_w", predictionCol="_calibrated")
    return learner.fit(merged)


def with_calibrated(model: IsotonicRegressionModel, df: DataFrame, score: str, out: str) -> DataFrame:
    mapped = model.transform(df.withColumn("_s", F.col(score)))
    return mapped.withColumnRenamed("_calibrated", out).drop("_s")


def logistic_gradient(model: LogisticRegressionModel, df: DataFrame, label: str, weight: str | None = None, strength: float = 1.0) -> DataFrame:
    """One row: rows, weight, and the gradient of the penalised mean loss at the model's coefficients, intercept last.

    The objective is that of ``fit_logistic``; at its minimum every entry is 0. One aggregation over the rows.
    """
    x = vector_to_array(FEATURES)
    w = F.col(weight) if weight else F.lit(1.0)
    rows = with_score(model, df, "_p").select(x.alias("_x"), w.alias("_w"), (w * (F.col("_p") - F.col(label))).alias("_off"))
    size = model.numFeatures
    sums = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.sum("_w").alias("weight"), *[F.sum(F.col("_off") * F.col("_x")[k]).alias(f"g{k}") for k in range(size)],
        F.sum("_off").alias(f"g{size}"),
    )
    pull = [float(c) / strength for c in model.coefficients] + [0.0]
    gradient = F.array(*[(F.col(f"g{k}") + F.lit(pull[k])) / F.col("weight") for k in range(size + 1)])
    return sums.select("rows", "weight", gradient.alias("gradient"))


TREE_NODES = "tree int, weight double, id int, feature int, threshold double, left int, right int, prediction double, gain double, rows double"


def tree_nodes(spark: SparkSession, model: GBTClassificationModel) -> DataFrame:
    """A fitted ensemble as a table: a row per node; leaves have no feature. Bounded by rounds and depth, not by the data."""
    rows = []
    for number, (tree, weight) in enumerate(zip(model.trees, model.treeWeights)):
        stack, count = [(tree._java_obj.rootNode(), 0)], 1  # type: ignore[attr-defined]
        while stack:
            node, at = stack.pop()
            leaf = node.subtreeDepth() == 0
            split = None if leaf else node.split()
            left, right = (None, None) if leaf else (count, count + 1)
            rows.append((
                number, float(weight), at, None if leaf else split.featureIndex(), None if leaf else float(split.threshold()), left, right,
                float(node.prediction()), None if leaf else float(node.gain()), float(node.impurityStats().count()),
            ))
            if not leaf:
                stack += [(node.leftChild(), left), (node.rightChild(), right)]
                count += 2
    return spark.createDataFrame(rows, TREE_NODES)


def tree_expression(nodes: DataFrame, names: Sequence[str]) -> Column:
    """The probability of class 1 as nested CASE expressions on plain columns: scoring without vectors or a model object."""
    trees: dict[int, dict] = {}
    for row in nodes.collect():  # a fitted model
        trees.setdefault(row["tree"], {})[row["id"]] = row

    def value(tree: dict, at: int) -> Column:
        node = tree[at]
        if node["feature"] is None:
            return F.lit(node["prediction"])
        goes_left = F.col(names[node["feature"]]) <= node["threshold"]
        return F.when(goes_left, value(tree, node["left"])).otherwise(value(tree, node["right"]))

    margin = F.lit(0.0)
    for number in sorted(trees):
        margin = margin + trees[number][0]["weight"] * value(trees[number], 0)
    return 1 / (1 + F.exp(-2 * margin))


def tree_importances(nodes: DataFrame, names: Sequence[str]) -> DataFrame:
    """feature, importance: gain times rows of the splits on it, as a share of all splits; features never used have 0."""
    used = nodes.filter(F.col("feature").isNotNull()).groupBy("feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("part"))
    total = used.agg(F.sum("part")).scalar()
    listed = nodes.sparkSession.createDataFrame(list(enumerate(names)), "number int, feature_name string")
    return listed.join(used, listed["number"] == used["feature"], "left").select(
        F.col("feature_name").alias("feature"), F.coalesce(safe_ratio(F.col("part"), total), F.lit(0.0)).alias("importance")
    )


def importances(spark: SparkSession, model, names: Sequence[str], top: int | None = None) -> DataFrame:
    """Coefficients or impurity importance per feature, largest first; one row per feature."""
    values = model.coefficients if hasattr(model, "coefficients") else model.featureImportances
    rows = [(name, float(value)) for name, value in zip(names, values.toArray())]
    ranked = spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return ranked.limit(top) if top else ranked


def risk_scores(df: DataFrame, model: Transformer, threshold: float = 0.02, name: str = "gb") -> DataFrame:
    """Batch risk of many events at once; ``model`` is a fitted model on features, or a ``scoring_pipeline``."""
    scored = with_score(model, df, "_risk")
    return scored.select(
        *df.columns,
        F.round("_risk", 4).alias("fatality_risk"),
        (F.col("_risk") >= threshold).alias("is_high_risk"),
        F.lit(name).alias("model"),
        F.lit(threshold).alias("threshold"),
    )


def scoring_pipeline(model: Transformer, names: Sequence[str], scaling: Scaling | None = None) -> PipelineModel:
    """Plain columns to probability: scaling, assembly and model as one thing to save, load and apply."""
    stages = [scaling_stage(scaling, suffix=SCALED)] if scaling else []
    inputs = [c + SCALED if scaling and c in scaling else c for c in names]
    return PipelineModel([*stages, VectorAssembler(inputCols=inputs, outputCol=FEATURES), model])


def save_model(stages: Sequence[Transformer], path: str) -> None:
    PipelineModel(list(stages)).write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def write_card(spark: SparkSession, card: dict, path: str) -> None:
    """Model card as one JSON row."""
    spark.range(1).select(*[F.lit(value).alias(name) for name, value in card.items()]).write.mode("overwrite").json(path)


def thresholded(score: str, threshold: float | Column) -> Column:
    return (F.col(score) >= threshold).cast("double")
