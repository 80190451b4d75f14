"""Quality of predictions. Everything but AUC derives from one small count table."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Rows per (label, prediction), both as double."""
    return pred.groupBy(F.col(label).cast("double").alias("label"),
                        F.col(prediction).cast("double").alias("prediction")) \
        .agg(F.count("*").alias("n"))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def per_class(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support of every class seen as label or prediction."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("label").alias("cls"), F.col("n").alias("support"),
                 F.lit(0).cast("long").alias("claimed"), hit.alias("hits")),
        F.struct(F.col("prediction").alias("cls"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("claimed"), F.lit(0).cast("long").alias("hits")))
    sums = (confusion(pred, label, prediction).select(F.inline(sides)).groupBy("cls")
            .agg(F.sum("support").alias("support"), F.sum("claimed").alias("claimed"),
                 F.sum("hits").alias("hits")))
    p = _ratio(F.col("hits"), F.col("claimed"))
    r = _ratio(F.col("hits"), F.col("support"))
    f1 = _ratio(F.lit(2.0) * F.col("hits"), F.col("claimed") + F.col("support"))
    return sums.select("cls", p.alias("precision"), r.alias("recall"), f1.alias("f1"),
                       "support", "hits")


def _weighted(name: str) -> Column:
    return F.try_divide(F.sum(F.col(name) * F.col("support")), F.sum("support"))


def evaluate(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row: accuracy, weighted F1, precision and recall, classes present, rows."""
    return per_class(pred, label, prediction).agg(
        F.try_divide(F.sum("hits").cast("double"), F.sum("support").cast("double"))
        .alias("accuracy"),
        _weighted("f1").alias("f1"), _weighted("precision").alias("weighted_precision"),
        _weighted("recall").alias("weighted_recall"),
        F.count_if(F.col("support") > 0).alias("n_classes"), F.sum("support").alias("n_rows"))


def accuracy(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row: the share of rows predicted right."""
    return evaluate(pred, label, prediction).select("accuracy")


def label_presence(pred: DataFrame, label: str) -> DataFrame:
    """Rows per label value."""
    return pred.groupBy(label).agg(F.count("*").alias("n_rows"))


def classification_report(pred: DataFrame, label: str,
                          prediction: str = "prediction") -> DataFrame:
    """Per class, then accuracy, macro average and weighted average.

    Columns: row, precision, recall, f1, support. The accuracy row repeats the
    accuracy in all three value columns.
    """
    classes = per_class(pred, label, prediction)
    names = ("precision", "recall", "f1")
    # the grand total of the rollup holds all averages, a class row only itself
    rolled = classes.rollup("cls").agg(
        F.grouping("cls").alias("total"), F.sum("support").alias("support"),
        F.try_divide(F.sum("hits").cast("double"), F.sum("support").cast("double")).alias("acc"),
        *(F.avg(c).alias(f"macro_{c}") for c in names),
        *(_weighted(c).alias(f"weighted_{c}") for c in names))

    def line(title, prefix):
        values = [F.col("acc" if prefix is None else prefix + c).alias(c) for c in names]
        return F.struct(title.alias("row"), *values, F.col("support"))

    lines = F.when(F.col("total") == 1, F.array(
        line(F.lit("accuracy"), None), line(F.lit("macro avg"), "macro_"),
        line(F.lit("weighted avg"), "weighted_"))).otherwise(
        F.array(line(F.col("cls").cast("int").cast("string"), "macro_")))
    return rolled.select(F.inline(lines))


def auc(pred: DataFrame, label: str, score: str = "rawPrediction", curve: str = "roc",
        bins: int = 0) -> float | None:
    """Area under the ROC or precision-recall curve; None with one class only.

    ``bins=0`` uses every distinct score and is exact. A positive number thins
    the curve to about that many points.
    """
    metric = {"roc": "areaUnderROC", "pr": "areaUnderPR"}[curve]
    if len(pred.select(label).distinct().limit(2).collect()) < 2:
        return None
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=score, numBins=bins,
                                         metricName=metric).evaluate(pred)
