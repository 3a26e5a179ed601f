"""Train/test splits, estimators by name and their evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import seeded_draw, seeded_hash
from shelfwise.functions.ordering import number_rows, quantiles
from shelfwise.operators.boosting import Boosted, fit_boosted
from shelfwise.operators.metrics import classification_metrics, regression_metrics, roc_auc, roc_auc_one_vs_rest
from shelfwise.operators.prep import FEATURES, feature_columns
from shelfwise.session import cut_lineage

MIN_ROWS = 50


def stratified_split(
    df: DataFrame, key: str, label: str | None = None, test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``is_test``: the same share of every label, fixed by key and seed."""
    draw = df.withColumn("_draw", seeded_hash(key, "split", seed))
    placed = number_rows(draw, [F.col("_draw"), F.col(key)], [label] if label else [])
    limit = F.floor(F.col("_total") * F.lit(test_share) + F.lit(0.5))
    return placed.withColumn("is_test", F.col("position") < limit).drop("_draw", "position", "_total")


def scaled_pipeline(train: DataFrame, features: Sequence[str], estimator) -> PipelineModel:
    """Scaling with the training statistics, assembly and the estimator as one stored model.

    The estimator learns from the rows that have all features; where one is missing, the prediction is null.
    """
    stats = train.agg(
        *[F.avg(c).alias(f"m_{c}") for c in features], *[F.stddev_pop(c).alias(f"s_{c}") for c in features]
    ).first()
    terms = []
    for c in features:
        mean, deviation = float(stats[f"m_{c}"] or 0.0), float(stats[f"s_{c}"] or 0.0)
        terms.append(f"(CAST({c} AS DOUBLE) - ({mean!r}D)) / {deviation!r}D AS {c}_z" if deviation else f"0.0D AS {c}_z")
    scaler = SQLTransformer(statement=f"SELECT *, {', '.join(terms)} FROM __THIS__")
    assembler = VectorAssembler(inputCols=[f"{c}_z" for c in features], outputCol="features", handleInvalid="keep")
    whole = " AND ".join(f"{c} IS NOT NULL" for c in features)
    out = estimator.getPredictionCol()
    told = SQLTransformer(statement=f"SELECT * EXCEPT ({out}), CASE WHEN {whole} THEN {out} END AS {out} FROM __THIS__")
    return Pipeline(stages=[scaler, assembler, estimator, told]).fit(train.where(whole))


def classifier(kind: str, n_rows: int, n_classes: int = 2, seed: int = 42):
    if kind == "random_forest":
        return RandomForestClassifier(numTrees=100, maxDepth=10, minInstancesPerNode=2, seed=seed)
    if kind == "gradient_boosting":
        boosted = GBTClassifier(maxIter=100, maxDepth=3, stepSize=0.1, seed=seed)
        return boosted if n_classes == 2 else OneVsRest(classifier=boosted)
    if kind == "logistic":
        return LogisticRegression(maxIter=1000, regParam=1.0 / max(n_rows, 1), elasticNetParam=0.0, standardization=False)
    raise ValueError(f"unknown model type: {kind}")


def regressor(kind: str, seed: int = 42):
    if kind == "random_forest":
        return RandomForestRegressor(
            numTrees=100, maxDepth=10, minInstancesPerNode=2, featureSubsetStrategy="all", seed=seed
        )
    raise ValueError(f"unknown model type: {kind}")


def _prepare(df: DataFrame, key: str, features: Sequence[str], label: str, stratify: bool, seed: int):
    base = feature_columns(df, features, label).select(key, *features, F.col(label).cast("double").alias("label"))
    marked = cut_lineage(stratified_split(base, key, "label" if stratify else None, seed=seed))
    return marked.where("NOT is_test").drop("is_test"), marked.where("is_test").drop("is_test")


def train_classifier(
    df: DataFrame,
    label: str,
    kind: str = "random_forest",
    features: Sequence[str] = FEATURES,
    key: str = "product_id",
    seed: int = 42,
    min_rows: int = 0,
    stratify_below: int = 50,
) -> tuple[PipelineModel | Boosted | None, DataFrame]:
    """Fit on 80 %, report accuracy, weighted precision/recall/F1 and ROC-AUC on 20 %.

    The split keeps the classes' shares if there are fewer than ``stratify_below`` of them.
    """
    classes = [r[0] for r in df.select(F.col(label).cast("int")).where(F.col(label).isNotNull()).distinct().collect()]
    train, test = _prepare(df, key, features, label, len(classes) < stratify_below, seed)
    sizes = (train.count(), test.count())
    if sum(sizes) < min_rows or len(classes) < 2:
        return None, df.sparkSession.range(1).select(F.lit("insufficient_data").alias("status"))
    if kind == "xgboost":
        task, outputs = ("binary", 2) if max(classes) <= 1 else ("softmax", max(classes) + 1)
        model = fit_boosted(train, features, task, outputs)
    else:
        model = scaled_pipeline(train, features, classifier(kind, sizes[0], len(classes), seed))
    predicted = model.transform(test)
    scores = classification_metrics(predicted)
    if "probability" in predicted.columns:
        predicted = predicted.withColumn("p", vector_to_array("probability"))
        if len(classes) == 2:
            top = max(classes)
            flat = predicted.select("label", F.col("p")[top].alias("s"))
            area = roc_auc(flat, F.col("label") == top, "s")
        else:
            area = roc_auc_one_vs_rest(predicted, "label", "p")
        scores = scores.withColumn("roc_auc", area.scalar())
    else:
        scores = scores.withColumn("roc_auc", F.lit(None).cast("double"))
    report = scores.select(
        F.lit(kind).alias("model_type"), "*", F.lit(sizes[0]).alias("n_train"), F.lit(sizes[1]).alias("n_test")
    )
    return model, report


def train_regressor(
    df: DataFrame,
    label: str,
    kind: str = "random_forest",
    features: Sequence[str] = ("rating", "reviews_count", "quantity"),
    key: str = "product_id",
    seed: int = 42,
) -> tuple[PipelineModel | Boosted, DataFrame]:
    train, test = _prepare(df, key, features, label, False, seed)
    if kind == "xgboost":
        model = fit_boosted(train, features, "squared")
    else:
        model = scaled_pipeline(train, features, regressor(kind, seed))
    report = regression_metrics(model.transform(test))
    return model, report.select(
        F.lit(kind).alias("model_type"), "*", F.lit(train.count()).alias("n_train"), F.lit(test.count()).alias("n_test")
    )


class ModelShelf:
    """Trained models by name."""

    def __init__(self):
        self._models: dict[str, PipelineModel | Boosted] = {}

    def add(self, name: str, model: PipelineModel | Boosted) -> None:
        self._models[name] = model

    def predict(self, df: DataFrame, name: str) -> DataFrame:
        if name not in self._models:
            raise ValueError(f"model {name} is not trained")
        return self._models[name].transform(df)


def trending_label(df: DataFrame, approximate: bool = False) -> DataFrame:
    """1 for a rating above 4 with more reviews than the median."""
    middle = quantiles(df, "reviews_count", {"m": 0.5}, approximate=approximate).scalar()
    hot = (F.col("rating") > 4.0) & (F.col("reviews_count") > middle)
    return df.withColumn("trending", F.coalesce(hot, F.lit(False)).cast("int"))


def trending_products(df: DataFrame, k: int = 5, seed: int = 42, min_rows: int = MIN_ROWS) -> DataFrame:
    """Products with the highest predicted probability of trending."""
    features = ("price", "rating", "reviews_count")
    base = trending_label(df)
    train, _ = _prepare(base, "product_id", features, "trending", False, seed)
    if train.count() < min_rows * 0.8 or train.select("label").distinct().count() < 2:
        return df.limit(0).select("product_id", "name", "category", F.lit(0.0).alias("score"))
    model = scaled_pipeline(train, features, GBTClassifier(maxIter=100, maxDepth=5, stepSize=0.1, seed=seed))
    scored = model.transform(feature_columns(df, features)).withColumn(
        "score", F.round(vector_to_array("probability")[1], 3)
    )
    return scored.select("product_id", "name", "category", "score").orderBy(F.desc("score"), "product_id").limit(k)


def above_median_price(df: DataFrame) -> DataFrame:
    middle = quantiles(df, "price", {"m": 0.5}).scalar()
    return df.withColumn("dear", (F.col("price") > middle).cast("int"))


def cross_validate(
    df: DataFrame, label: str, kind: str = "random_forest", features: Sequence[str] = FEATURES,
    key: str = "product_id", folds: int = 5, seed: int = 42,
) -> float:
    """Mean accuracy over folds fixed by key and seed."""
    base = feature_columns(df, features, label).select(
        *features, F.col(label).cast("double").alias("label"), seeded_draw(key, "fold", folds, seed).alias("fold")
    )
    data = cut_lineage(VectorAssembler(inputCols=list(features), outputCol="features").transform(base))
    validator = CrossValidator(
        estimator=classifier(kind, data.count(), 2, seed),
        estimatorParamMaps=ParamGridBuilder().build(),
        evaluator=MulticlassClassificationEvaluator(metricName="accuracy"),
        numFolds=folds,
        foldCol="fold",
    )
    return validator.fit(data).avgMetrics[0]
