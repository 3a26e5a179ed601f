"""Classification metrics from counts, without gathering predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.ordering import running_totals


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 (0 where undefined)."""
    cells = confusion_matrix(df, label, prediction)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    actual = cells.groupBy(F.col("label").alias("c")).agg(F.sum("n").alias("support"), F.sum(hit).alias("tp"))
    predicted = cells.groupBy(F.col("prediction").alias("c")).agg(F.sum("n").alias("predicted"))
    each = actual.join(predicted, "c", "left")
    precision = F.coalesce(F.col("tp") / F.col("predicted"), F.lit(0.0))
    recall = F.col("tp") / F.col("support")
    each = each.select("support", "tp", precision.alias("p"), recall.alias("r"))
    f1 = F.when(F.col("p") + F.col("r") > 0, 2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))).otherwise(0.0)
    n = F.sum("support")
    return each.agg(
        (F.sum("tp") / n).alias("accuracy"),
        (F.sum(F.col("support") * F.col("p")) / n).alias("precision"),
        (F.sum(F.col("support") * F.col("r")) / n).alias("recall"),
        (F.sum(F.col("support") * f1) / n).alias("f1"),
    )


def roc_auc(df: DataFrame, positive, score: str) -> DataFrame:
    """Area under the ROC curve by ranks, ties counted half; NULL if a class is missing.

    Rows collapse to one per distinct score; negatives below each score come from
    a distributed running total.
    """
    counted = df.groupBy(F.col(score).alias("s")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )
    cum = running_totals(counted, [F.col("s")], ["neg"])
    won = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / F.lit(2.0)))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return cum.agg((won / F.nullif(pairs, F.lit(0.0))).alias("roc_auc"))


def roc_auc_one_vs_rest(df: DataFrame, label: str, probability: str) -> DataFrame:
    """Unweighted mean of the one-against-rest areas; entry c of the array ``probability`` is the score of class c.

    All classes in one keyed aggregate; a class without positives or without negatives has no area.
    """
    scores = df.select(F.col(label).alias("_y"), F.posexplode(probability).alias("c", "s"))
    counted = scores.groupBy("c", "s").agg(
        F.count_if(F.col("_y") == F.col("c")).alias("pos"), F.count_if(F.col("_y") != F.col("c")).alias("neg")
    )
    cum = running_totals(counted, [F.col("s")], ["neg"], ["c"])
    won = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / F.lit(2.0)))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    areas = cum.groupBy("c").agg((won / F.nullif(pairs, F.lit(0.0))).alias("area"))
    return areas.agg(F.avg("area").alias("roc_auc"))


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    error = F.col(label) - F.col(prediction)
    around_mean = F.var_pop(label) * F.count(label)
    mse = F.avg(error * error)
    return df.agg(
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        (F.lit(1.0) - F.sum(error * error) / F.nullif(around_mean, F.lit(0.0))).alias("r2"),
    )
