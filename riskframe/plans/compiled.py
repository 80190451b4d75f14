"""Fitted models as plain SQL expressions.

A linear or tree model is a few numbers. Written out as arithmetic and CASE it scores in
one generated projection, without vectors, a model file or Spark ML on the reading side,
and the same text runs in other SQL engines. Numbers are written with exponents, which
makes them doubles everywhere, to the last digit.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (GBTClassificationModel, LogisticRegressionModel,
                                       RandomForestClassificationModel)
from pyspark.ml.feature import (OneHotEncoderModel, StandardScalerModel, StringIndexerModel,
                                VectorAssembler)
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.operators.boosting import BoostedTrees
from riskframe.plans.train import feature_importance
from riskframe.sources.tables import scratch_path

#: The most nodes or slots that are written into an expression: its compilation grows with them.
MAX_NODES = 5_000
SIGMOID = "(1e0 / (1e0 + exp(-_raw)))"


def _above(limit: str, value: str = "_raw") -> str:
    return f"CASE WHEN {value} > {limit} THEN 1e0 WHEN {value} IS NOT NULL THEN 0e0 END"


def number(x: float) -> str:
    """A double literal of Spark and of other engines alike."""
    text = repr(float(x))
    return f"({text if 'e' in text else text + 'e0'})"


def name(column: str) -> str:
    """A quoted column, if quotes are needed; those that need any cannot be shared by engines."""
    if not column.replace("_", "a").isalnum() or column[0].isdigit():
        raise ValueError(f"column {column!r} cannot be written in plain SQL; rename it")
    return column


def text(value: str) -> str:
    if "\\" in value:
        raise ValueError("backslashes in category values are read differently by SQL engines")
    return "'" + value.replace("'", "''") + "'"


def total(terms: Sequence[str]) -> str:
    """A sum as a balanced tree, so that long ones stay shallow."""
    if len(terms) <= 1:
        return terms[0] if terms else number(0)
    half = len(terms) // 2
    return f"({total(terms[:half])} + {total(terms[half:])})"


@dataclass(frozen=True)
class CompiledModel:
    """``inputs`` names the columns read and the expressions they are read by, ``slots`` the
    model's features over those; ``raw`` is written over the slots, ``probability`` (of
    class 1) and ``prediction`` (0 or 1) over its value ``_raw``. A row with a missing
    input has neither, unless ``fills`` says that the model takes missing values."""

    inputs: tuple[tuple[str, str], ...]
    slots: tuple[tuple[str, str], ...]
    raw: str
    probability: str
    prediction: str
    fills: bool = False

    def sql(self, table: str, key: str, digits: int | None = None) -> str:
        """A query: key, prediction, risk_probability, risk_band for every row of ``table``."""
        read = "".join(f", {expression} AS {alias}" for alias, expression in self.inputs)
        slots = "".join(f", {expression} AS {alias}" for alias, expression in self.slots)
        p = f"round(_p, {digits})" if digits is not None else "_p"
        missing = " OR ".join(f"{alias} IS NULL" for alias, _ in self.inputs)
        known = "TRUE" if self.fills or not self.inputs else f"NOT ({missing})"
        if self.fills:
            slots = "".join(f", {alias}" for alias, _ in self.inputs)
        return (f"SELECT {name(key)}, _y AS prediction, {p} AS risk_probability, "
                "CASE WHEN _y = 1 THEN 'HIGH RISK' WHEN _y = 0 THEN 'LOW RISK' END AS risk_band FROM ("
                f"SELECT {name(key)}, {self.prediction} AS _y, {self.probability} AS _p FROM ("
                f"SELECT {name(key)}, CASE WHEN _known THEN {self.raw} END AS _raw FROM ("
                f"SELECT {name(key)}, {known} AS _known{slots} FROM ("
                f"SELECT {name(key)}{read} FROM {table}) AS _read) AS _slots) AS _told) AS _scored")

    def score(self, df: DataFrame, key: str) -> DataFrame:
        """The same for a DataFrame, as one projection."""
        return df.sparkSession.sql(self.sql("{rows}", key), rows=df)


def _numeric(column: str) -> str:
    return f"nullif(CAST({name(column)} AS DOUBLE), CAST('NaN' AS DOUBLE))"


def compile_boosted(model: BoostedTrees) -> CompiledModel:
    """Boosted trees; missing values go the way each split learned."""
    _check(len(model.nodes))
    by_tree: dict[int, dict[int, dict]] = {}
    for n in model.nodes:
        by_tree.setdefault(n["tree"], {})[n["node"]] = n

    def written(tree: dict[int, dict], at: int) -> str:
        n = tree[at]
        if n["feature"] is None:
            return number(n["step"])
        low, high = written(tree, 2 * at), written(tree, 2 * at + 1)
        x = f"_x{n['feature']}"
        if math.isinf(n["threshold"]):
            return f"CASE WHEN {x} IS NOT NULL THEN {low} ELSE {high} END"
        cut = number(n["threshold"])
        if n["missing_right"]:
            return f"CASE WHEN {x} <= {cut} THEN {low} ELSE {high} END"
        return f"CASE WHEN {x} > {cut} THEN {high} ELSE {low} END"
    margin = total([written(by_tree[t], 1) for t in sorted(by_tree)])
    inputs = tuple((f"_x{i}", _numeric(c)) for i, c in enumerate(model.features))
    return CompiledModel(inputs, (), margin, SIGMOID, _above("0e0"), True)


def _check(nodes: int) -> None:
    if nodes > MAX_NODES:
        raise ValueError(f"{nodes} nodes are too many for one expression, at most {MAX_NODES}; use score()")


def saved_nodes(spark, model) -> DataFrame:
    """The node table a fitted forest or boosted model is saved with: tree, id, prediction,
    stats (weight by class), gain, left, right, feature (-1 for a leaf), categories, cut. Where
    ``categories`` is -1, values up to cut[0] go left, else the values listed in ``cut``."""
    path = scratch_path(spark, "model-nodes")
    model.write().save(path)
    n = F.col("nodeData")
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("id"), n["prediction"].alias("prediction"),
        n["impurityStats"].alias("stats"), n["gain"].alias("gain"), n["leftChild"].alias("left"),
        n["rightChild"].alias("right"), n["split"]["featureIndex"].alias("feature"),
        n["split"]["numCategories"].alias("categories"), n["split"]["leftCategoriesOrThreshold"].alias("cut"))


def _slots(model: PipelineModel) -> tuple[list[tuple[str, str]], list[str]]:
    """Inputs, and the expression of each slot of the feature vector."""
    values: dict[str, list[str]] = {}
    slots: dict[str, list[str]] = {}
    inputs: list[tuple[str, str]] = []

    def expressions(columns: Sequence[str]) -> list[str]:
        out = []
        for c in columns:
            if c not in slots:
                inputs.append((f"_x{len(inputs)}", _numeric(c)))
                slots[c] = [inputs[-1][0]]
            out += slots[c]
        return out

    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            if stage.getHandleInvalid() != "keep":
                raise ValueError("only indexers that keep unseen values can be written out")
            for column, output, labels in zip(stage.getInputCols(), stage.getOutputCols(), stage.labelsArray):
                values[output] = [column, *labels]
        elif isinstance(stage, OneHotEncoderModel):
            for index, output in zip(stage.getInputCols(), stage.getOutputCols()):
                column, *labels = values[index]
                given = [f"{name(column)} = {text(v)}" for v in labels]
                seen = f"{name(column)} IN ({', '.join(map(text, labels))})" if labels else "FALSE"
                slots[output] = [f"_c{len(inputs)}_{i}" for i in range(len(labels) + 1)]
                for alias, test in zip(slots[output], [*given, f"NOT coalesce({seen}, FALSE)"]):
                    inputs.append((alias, f"CASE WHEN {test} THEN 1e0 ELSE 0e0 END"))
        elif isinstance(stage, VectorAssembler):
            slots[stage.getOutputCol()] = expressions(stage.getInputCols())
        elif isinstance(stage, StandardScalerModel):
            scaled = []
            for x, mean, std in zip(slots[stage.getInputCol()], stage.mean.toArray(), stage.std.toArray()):
                moved = f"({x} - {number(mean)})" if stage.getWithMean() else x
                factor = (1.0 / std if std else 0.0) if stage.getWithStd() else 1.0
                scaled.append(f"({moved} * {number(factor)})")
            slots[stage.getOutputCol()] = scaled
    return inputs, slots["features"]


def compile_model(model: PipelineModel, spark=None) -> CompiledModel:
    """A fitted pipeline of :func:`riskframe.plans.fit_model` as expressions.

    Logistic regression, random forest and boosted trees of two classes. Refuses models of
    over ``MAX_NODES`` nodes or slots.
    """
    inputs, features = _slots(model)
    _check(len(features))
    named = tuple((f"_s{i}", f"coalesce({x}, 0e0)") for i, x in enumerate(features))
    slots = [alias for alias, _ in named]
    last = model.stages[-1]
    if isinstance(last, LogisticRegressionModel):
        terms = [f"({number(w)} * {x})" for w, x in zip(last.coefficients.toArray(), slots) if w]
        margin = total([*terms, number(last.intercept)])
        return CompiledModel(tuple(inputs), named, margin, SIGMOID, _above(number(last.getThreshold()), SIGMOID))
    if isinstance(last, RandomForestClassificationModel):
        if last.numClasses != 2:
            raise ValueError("only models of two classes can be written out")
        mean = total([_tree(t, slots, _share) for t in _trees(last, spark)])
        return CompiledModel(tuple(inputs), named, f"({mean} / {number(last.getNumTrees)})", "_raw", _above("5e-1"))
    if isinstance(last, GBTClassificationModel):
        trees = [f"({number(w)} * {_tree(t, slots, lambda n: n['prediction'])})"
                 for w, t in zip(last.treeWeights, _trees(last, spark))]
        margin = total(trees)
        return CompiledModel(tuple(inputs), named, f"(2e0 * {margin})", SIGMOID, _above("0e0"))
    raise ValueError(f"{type(last).__name__} cannot be written out")


def _share(leaf: Row) -> float:
    """The share of class 1 in a leaf."""
    whole = sum(leaf["stats"])
    return leaf["stats"][1] / whole if whole else 0.0


def _trees(model, spark) -> list[dict[int, Row]]:
    _check(sum(t.numNodes for t in model.trees))
    found: dict[int, dict[int, Row]] = {}
    for n in saved_nodes(spark or SparkSession.active(), model).collect():  # at most MAX_NODES
        found.setdefault(n["tree"], {})[n["id"]] = n
    return [found[t] for t in sorted(found)]


def _tree(nodes: dict[int, Row], slots: Sequence[str], value: Callable[[Row], float]) -> str:
    def goes_left(n: Row) -> str:
        slot = slots[n["feature"]]
        if n["categories"] < 0:
            return f"{slot} <= {number(n['cut'][0])}"
        return f"{slot} IN ({', '.join(map(number, n['cut']))})" if n["cut"] else "FALSE"

    def written(at: int) -> str:
        n = nodes[at]
        if n["left"] < 0:
            return number(value(n))
        return f"CASE WHEN {goes_left(n)} THEN {written(n['left'])} ELSE {written(n['right'])} END"
    return written(0)


def replayed_importance(model: PipelineModel, df: DataFrame) -> DataFrame:
    """slot, feature, importance of a fitted forest or boosted model, out of its saved node table.

    A split counts with its gain times the weight it parts. In a forest each tree's splits
    are made to sum to 1 first; then all are added by slot and made to sum to 1. Least
    important first.
    """
    spark = df.sparkSession
    nodes = saved_nodes(spark, model.stages[-1]).where(F.col("left") >= 0)
    forest = isinstance(model.stages[-1], RandomForestClassificationModel)
    # a forest's statistics are weights by class, those of regression trees start with the weight
    weight = F.aggregate("stats", F.lit(0.0), lambda a, x: a + x) if forest else F.get("stats", F.lit(0))
    parted = nodes.select("tree", "feature", (F.col("gain") * weight).alias("gain"))
    by_tree = Window.partitionBy("tree")
    tree_gain = F.sum("gain").over(by_tree) if forest else F.lit(1.0)
    shares = parted.groupBy("tree", "feature").agg(F.sum("gain").alias("gain")).withColumn(
        "share", F.try_divide("gain", tree_gain))
    summed = shares.groupBy(F.col("feature").alias("slot")).agg(F.sum("share").alias("share"))
    whole = summed.agg(F.sum("share").alias("whole"))
    names = feature_importance(model, df).select("slot", "feature")
    return (names.join(summed, "slot", "left").join(F.broadcast(whole))     # one row
            .select("slot", "feature", F.coalesce(F.try_divide("share", "whole"), F.lit(0.0)).alias("importance"))
            .orderBy("importance", "slot"))
