"""Fit, score, explain and evaluate risk models with Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, RandomForestClassifier)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import known
from riskframe.operators.boosting import BoostingParams
from riskframe.operators.cell_trees import fit_cells
from riskframe.operators.clean import MAX_CLASSES
from riskframe.operators.evaluate import auc, evaluate
from riskframe.operators.features import assembler, check_cardinality, encoder, indexer
from riskframe.operators.sampling import check_coverage, stratified_split
from riskframe.plans.prepare import Preparation
from riskframe.sources.tables import stored
from riskframe.spec import DatasetSpec

# Parameters used where the caller gives none.
DEFAULTS = {
    "rf": {"numTrees": 200, "maxDepth": 10, "minInstancesPerNode": 2,
           "featureSubsetStrategy": "sqrt", "seed": 42},
    "gbt": {"maxIter": 80, "maxDepth": 6, "stepSize": 0.08, "subsamplingRate": 0.8,
            "minInstancesPerNode": 3, "seed": 42},
    "lr": {"maxIter": 300, "regParam": 0.001, "elasticNetParam": 0.1},
}

# The slow, heavily sampled boosting variant with leaf and split penalties.
SLOW_BOOSTING = BoostingParams(rounds=300, depth=4, rate=0.05, rows=0.8, columns=0.8, gamma=1.0,
                               l1=0.5, l2=1.0, seed=42)

#: Training rows beyond which trees grow over cells of equal rows.
CELLS_FROM = 200_000

_CLASSIFIERS = {"rf": RandomForestClassifier, "gbt": GBTClassifier, "lr": LogisticRegression}


def build_stages(numeric: Sequence[str], categorical: Sequence[str], label: str, algo: str = "lr",
                 params: Mapping | None = None, weight: str | None = "_class_weight",
                 scale_encoded: bool = False) -> Pipeline:
    """Index and encode the categoricals, assemble, scale the numeric columns, classify.

    ``algo`` is rf, gbt or lr; any other name means lr. ``scale_encoded=True``
    scales the encoded slots too; centring turns them into dense vectors.
    """
    algo = algo if algo in _CLASSIFIERS else "lr"
    encoded = [f"{c}_ohe" for c in categorical]
    stages = [indexer(*categorical), encoder(*categorical)] if categorical else []
    if scale_encoded or not encoded:
        stages += [assembler([*numeric, *encoded]),
                   StandardScaler(inputCol="raw_features", outputCol="features", withMean=True,
                                  withStd=True)]
    else:
        stages += [assembler([*numeric, *encoded]), assembler(numeric, "numeric_features"),
                   StandardScaler(inputCol="numeric_features", outputCol="scaled_features",
                                  withMean=True, withStd=True),
                   assembler(["scaled_features", *encoded], "features")]
    settings = {**DEFAULTS[algo], **(params or {})}
    classifier = _CLASSIFIERS[algo](labelCol=label, featuresCol="features", **settings)
    if weight:
        classifier.setWeightCol(weight)
    return Pipeline(stages=[*stages, classifier])


def training_partitions(rows: int) -> int:
    """Partitions of a training table, by its counted rows alone, never by cores: one for
    every 10,000 rows, from 64 partitions on one for every 200,000."""
    return max(1, min(64, -(-rows // 10_000)), -(-rows // 200_000))


def fit_model(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str,
              algo: str = "lr", params: Mapping | None = None,
              weight: str | None = "_class_weight", scale_encoded: bool = False,
              key: str | None = None, partitions: int | None = None,
              most: int = MAX_CLASSES, cells_from: int = CELLS_FROM) -> PipelineModel:
    """Fit the stages; refuses categoricals with more than ``most`` values.

    Training passes over the rows many times, so they are stored once, only the
    columns in use. With ``key`` they are dealt to ``partitions`` by its hash and
    sorted: row samples depend on both, so a seed then gives the same model on any
    number of cores. ``partitions`` follows the counted rows, see ``training_partitions``.
    Trees of more than ``cells_from`` rows with a key grow over cells of equal rows, if
    these are few enough: see ``operators.cell_trees``.
    """
    check_cardinality(train, categorical, most)
    used = [*numeric, *categorical, label, *([weight] if weight else [])]
    if key:
        rows = stored(train.select(key, *(c for c in used if c != key)), "training")
        count = rows.count()
        if count > cells_from and algo in ("rf", "gbt") and partitions is None:
            *first, classifier = build_stages(numeric, categorical, label, algo, params, weight, scale_encoded).getStages()
            ready = Pipeline(stages=first).fit(rows)
            model = fit_cells(classifier, ready.transform(rows), rows.columns)
            if model is not None:
                return PipelineModel([*ready.stages, model])
        parts = partitions or training_partitions(count)
        rows = rows.repartition(parts, key).sortWithinPartitions(key)
    else:
        rows = stored(train.select(*used), "training")
    return build_stages(numeric, categorical, label, algo, params, weight,
                        scale_encoded).fit(rows)


def score(model: PipelineModel, df: DataFrame, key: str) -> DataFrame:
    """key, prediction, risk_probability (of class 1), risk_band for every row.

    Rows the model cannot score, because a numeric feature is missing, stay in
    the result with nulls. One pass: they go through with a placeholder.
    """
    inputs = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    inputs = [c for c in inputs if c in df.columns]
    complete = F.lit(True)
    for c in inputs:
        complete = complete & known(df, c).isNotNull()
    filled = df.withColumn("_complete", complete).withColumns(
        {c: F.coalesce(known(df, c), F.lit(0).cast(df.schema[c].dataType)) for c in inputs})
    scored = model.transform(filled)

    def told(value: Column) -> Column:
        return F.when(F.col("_complete"), value)
    band = F.when(F.col("prediction") == 1, "HIGH RISK").otherwise("LOW RISK")
    return scored.select(key, told(F.col("prediction")).alias("prediction"),
                         told(vector_to_array("probability")[1]).alias("risk_probability"),
                         told(band).alias("risk_band"))


def feature_importance(model: PipelineModel, df: DataFrame) -> DataFrame:
    """slot, feature, importance, least important first.

    Slot names come from the metadata of the assembled vector, so each slot of
    an encoded column carries its own name. Only tree models have importances.
    """
    importances = getattr(model.stages[-1], "featureImportances", None)
    if importances is None:
        raise ValueError("only tree models have feature importances")
    attrs = model.transform(df.limit(0)).schema["raw_features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    rows = [(i, names.get(i, f"feature_{i}"), float(v))
            for i, v in enumerate(importances.toArray())]
    return df.sparkSession.createDataFrame(rows, "slot int, feature string, importance double") \
        .orderBy("importance", "slot")


def train_and_evaluate(df: DataFrame, spec: DatasetSpec, algo: str = "gbt",
                       params: Mapping | None = None, test_frac: float = 0.2, seed: int = 42,
                       preparation: Preparation | None = None):
    """Split by key and class, learn the preparation and the model on the train
    side, measure on the test side.

    Returns (prepared model, fitted stages, metrics dict). Metrics are accuracy,
    f1, weighted_precision, weighted_recall, auc_roc and auc_pr.
    """
    if not spec.key:
        raise ValueError("the dataset spec needs a key column to split by")
    train, test = stratified_split(df, spec.label, spec.key, test_frac, seed)
    prepared = (preparation or Preparation(spec)).fit(train)
    train, test = prepared.transform(train), prepared.transform(test)
    check_coverage(train, test, spec.label)
    numeric, cats = prepared.feature_columns(train)
    model = fit_model(train, numeric, cats, spec.label, algo,
                      params if params is not None else spec.params.get(algo), key=spec.key)
    predicted = stored(model.transform(test).select(spec.label, "prediction", "rawPrediction"),
                       "predicted")
    metrics = evaluate(predicted, spec.label).first().asDict()
    metrics["auc_roc"] = auc(predicted, spec.label)
    metrics["auc_pr"] = auc(predicted, spec.label, curve="pr")
    return prepared, model, metrics
