import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskframe.operators import cell_trees
from riskframe.operators.cell_trees import TreeParams, cuts_of, fit_cells, times_drawn
from riskframe.plans import Preparation, build_stages, fit_model, score
from riskframe.sources import load_model, save_model, scratch_path
from test_train import SPEC, patients

NUMERIC = ["age", "chol", "ca"]


def prepared(spark, n=600):
    return Preparation(SPEC).fit(patients(spark, n)).transform(patients(spark, n))


def chances(model, df):
    return [r[0] for r in score(model, df, "id").orderBy("id").select("risk_probability").collect()]


ALL = {"featureSubsetStrategy": "all", "bootstrap": False, "seed": 1, "maxBins": 64}


@pytest.mark.parametrize("algo, params", [
    ("rf", {**ALL, "numTrees": 1, "maxDepth": 4, "minInstancesPerNode": 20}),
    ("gbt", {"maxIter": 3, "maxDepth": 3, "subsamplingRate": 1.0, "minInstancesPerNode": 20, "seed": 1,
             "maxBins": 64})])
def test_without_draws_the_model_is_that_of_spark_ml(spark, algo, params):
    df = prepared(spark)
    plain, cells = (fit_model(df, NUMERIC, ["sex"], "num", algo, params, key="id", cells_from=n) for n in (10**9, 0))
    assert cells.stages[-1].totalNumNodes == plain.stages[-1].totalNumNodes > 5
    assert chances(cells, df) == pytest.approx(chances(plain, df), abs=1e-9)
    assert cells.stages[-1].featureImportances.toArray() == pytest.approx(plain.stages[-1].featureImportances.toArray(), abs=1e-9)
    assert type(cells.stages[-1]) is type(plain.stages[-1])
    again = load_model(save_model(cells, scratch_path(spark, "model")))
    assert chances(again, df) == chances(cells, df)


@pytest.mark.parametrize("algo, params", [("rf", {"numTrees": 20, "maxDepth": 4, "seed": 1}),
                                          ("gbt", {"maxIter": 5, "maxDepth": 3, "subsamplingRate": 0.8, "seed": 1})])
def test_draws_are_the_same_under_any_partitions_and_find_the_signal(spark, algo, params, monkeypatch):
    df, both = prepared(spark), []
    for parts in (1, 7):
        monkeypatch.setattr(cell_trees, "partitions_for", lambda rows, parts=parts: parts)
        model = fit_model(df.repartition(parts), NUMERIC, ["sex"], "num", algo, params, key="id", cells_from=0)
        both.append(chances(model, df))
    assert both[0] == both[1]
    plain = chances(fit_model(df, NUMERIC, ["sex"], "num", algo, params, key="id"), df)
    assert both[0] != plain
    assert np.corrcoef(both[0], plain)[0, 1] > 0.95


def test_rows_are_drawn_as_often_as_a_bootstrap_draws_them():
    p = cell_trees.params_of(build_stages(["a"], [], "y", "rf").getStages()[-1], 9)
    assert (p.trees, p.depth, p.least, p.take, p.bins, p.seed) == (200, 10, 2, 3, 32, 42)
    draws = np.random.default_rng(0).integers(0, 2**63, 200_000).astype(np.uint64)
    one, two = times_drawn(draws, 0, p), times_drawn(draws, 1, p)
    share = np.bincount(one, minlength=9)[:7] / len(one)
    assert share == pytest.approx([0.36788, 0.36788, 0.18394, 0.06131, 0.01533, 0.00307, 0.00051], abs=0.004)
    assert abs(np.corrcoef(one, two)[0, 1]) < 0.01
    assert (times_drawn(draws, 0, TreeParams(1, 2, 1, 0.0, 1, (), 32, 1)) == 1).all()


def test_alike_rows_of_one_key_are_drawn_apart(spark):
    once = spark.createDataFrame([(i % 2 * 1.0, Vectors.dense([i % 2 * 1.0, 0.0]), 7) for i in range(400)], ["y", "features", "id"])
    classifier = build_stages(["a"], [], "y", "rf", {"numTrees": 3}, weight=None).getStages()[-1]
    model = fit_cells(classifier, once, ["id", "y"])
    drawn = [tree._call_java("rootNode").impurityStats().count() for tree in model.trees]     # of 400 rows, 200 of each label
    assert all(300 < n < 500 for n in drawn) and len(set(drawn)) > 1


def test_rare_values_of_few_keep_their_cuts_and_others_are_cut_evenly(spark):
    df = spark.range(2_000).select(F.when(F.col("id") < 3, 5.0).when(F.col("id") < 6, 1.0).otherwise(0.0).alias("a"),
                                   F.col("id").cast("double").alias("b"))
    few, many = cuts_of(df, ["a", "b"], 32)
    assert few == [0.5, 3.0]
    assert len(many) == 31 and np.diff(many) == pytest.approx(62.5, abs=1)


def test_tables_with_many_cells_or_odd_labels_are_left_to_spark_ml(spark, monkeypatch):
    df, params = prepared(spark), {"numTrees": 3, "maxDepth": 3, "seed": 1}
    plain = chances(fit_model(df, NUMERIC, [], "num", "rf", params, key="id"), df)
    three = df.withColumn("num", F.when(F.col("id") == 5, 2).otherwise(F.col("num")))
    assert fit_model(three, NUMERIC, [], "num", "rf", params, key="id", cells_from=0).stages[-1].numClasses == 3
    monkeypatch.setattr(cell_trees, "COUNTS", 30)
    assert chances(fit_model(df, NUMERIC, [], "num", "rf", params, key="id", cells_from=0), df) == plain
