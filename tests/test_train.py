import math

import pytest
from pyspark.sql import functions as F

from riskframe import DIABETES, DatasetSpec
from riskframe.functions import normal
from riskframe.plans import (Preparation, build_stages, feature_importance, fit_model, score,
                             train_and_evaluate)
from riskframe.plans.train import training_partitions
from riskframe.sources import load_model, save_model, scratch_path
from conftest import rows

SPEC = DatasetSpec(label="num", key="id", binarize=True, drop=("origin",), categorical=("sex",),
                   zero_as_missing=("chol",), interactions=(("chol", "age"),), log_columns=("chol",))


def patients(spark, n=600):
    """A table whose label follows age, with zero-coded and missing cells."""
    z = normal(1, F.col("id"), "z")
    return spark.range(n).select(
        "id", (F.col("id") % 60 + 20).cast("int").alias("age"),
        F.when(F.col("id") % 9 == 0, 0).otherwise(200 + F.col("id") % 50).cast("int").alias("chol"),
        F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 2 == 0, " Male").otherwise("FEMALE").alias("sex"),
        F.when(F.col("id") % 11 != 0, F.col("id") % 5).cast("double").alias("ca"), F.lit("x").alias("origin"),
        F.when(F.col("id") % 60 + z * 5 > 35, 3).otherwise(0).alias("num"))


def test_preparation_fills_everything_and_reports_absent_columns(spark):
    df = patients(spark)
    model = Preparation(SPEC).fit(df)
    out = model.transform(df)
    assert out.columns == ["id", "age", "chol", "sex", "ca", "num", "chol_x_age", "chol_log", "_class_weight"]
    assert out.filter(" or ".join(f"{c} is null" for c in out.columns)).count() == 0
    assert {r[0] for r in out.select("sex").distinct().collect()} == {"male", "female"}
    unlabelled = model.transform(df.drop("num"))
    assert "_class_weight" not in unlabelled.columns
    assert model.feature_columns(out) == (["age", "chol", "ca", "chol_x_age", "chol_log"], ["sex"])
    with pytest.raises(ValueError, match="absent"):
        Preparation(DIABETES, strict=True).fit(df)


def test_default_preparation_ignores_the_label(spark):
    df = patients(spark)
    model = Preparation(SPEC).fit(df)
    flipped = df.withColumn("num", 3 - F.col("num"))
    cols = ["id", "age", "chol", "ca", "chol_x_age", "chol_log"]
    assert sorted(rows(model.transform(df).select(*cols))) == sorted(rows(model.transform(flipped).select(*cols)))
    leaky = Preparation(SPEC, class_medians=True).fit(df)
    assert leaky.medians.medians["chol"][0] != leaky.medians.medians["chol"][1]


@pytest.mark.parametrize("algo, params", [("gbt", {"maxIter": 5, "maxDepth": 3}),
                                          ("rf", {"numTrees": 10, "maxDepth": 4}), ("lr", {"maxIter": 30})])
def test_training_finds_the_signal(spark, algo, params):
    _, _, metrics = train_and_evaluate(patients(spark), SPEC, algo, params)
    assert metrics["auc_roc"] > 0.9 and metrics["accuracy"] > 0.8
    assert metrics["auc_pr"] > 0.7      # one wrong row at the very top costs the curve its start


def test_saved_model_scores_alike_and_keeps_every_row(spark):
    df = Preparation(SPEC).fit(patients(spark)).transform(patients(spark))
    model = fit_model(df, ["age", "chol", "ca"], ["sex"], "num", "rf", {"numTrees": 5, "maxDepth": 3})
    broken = df.withColumn("ca", F.when(F.col("id") % 10 != 0, F.col("ca"))).withColumn(
        "sex", F.when(F.col("id") == 1, "unseen").otherwise(F.col("sex"))).drop("num", "_class_weight")
    scored = score(model, broken, "id").orderBy("id").collect()
    assert len(scored) == 600 and sum(r["prediction"] is None for r in scored) == 60
    assert all(r["risk_band"] == ("HIGH RISK" if r["prediction"] == 1 else "LOW RISK")
               for r in scored if r["prediction"] is not None)
    loaded = load_model(save_model(model, scratch_path(spark, "model")))
    again = score(loaded, broken, "id").orderBy("id").collect()
    assert [r["risk_probability"] for r in again] == [r["risk_probability"] for r in scored]
    importance = feature_importance(model, df).collect()
    assert [r["feature"] for r in sorted(importance, key=lambda r: r["slot"])] == \
        ["age", "chol", "ca", "sex_ohe_female", "sex_ohe_male", "sex_ohe___unknown"]
    assert sum(r["importance"] for r in importance) == pytest.approx(1)
    assert importance[-1]["feature"] == "age"


def test_stages_follow_the_requested_model(spark):
    names = [type(s).__name__ for s in build_stages(["a"], ["c"], "y", "rf").getStages()]
    assert names == ["StringIndexer", "OneHotEncoder", "VectorAssembler", "VectorAssembler", "StandardScaler",
                     "VectorAssembler", "RandomForestClassifier"]
    names = [type(s).__name__ for s in build_stages(["a"], ["c"], "y", "rf", scale_encoded=True).getStages()]
    assert names == ["StringIndexer", "OneHotEncoder", "VectorAssembler", "StandardScaler", "RandomForestClassifier"]
    assert type(build_stages(["a"], [], "y", "no such model").getStages()[-1]).__name__ == "LogisticRegression"
    gbt = build_stages(["a"], [], "y", "gbt").getStages()[-1]
    assert (gbt.getMaxIter(), gbt.getMaxDepth(), gbt.getStepSize(), gbt.getSubsamplingRate(),
            gbt.getMinInstancesPerNode(), gbt.getSeed()) == (80, 6, 0.08, 0.8, 3, 42)
    rf = build_stages(["a"], [], "y", "rf").getStages()[-1]
    assert (rf.getNumTrees(), rf.getMaxDepth(), rf.getWeightCol()) == (200, 10, "_class_weight")


def test_sparse_scaling_predicts_alike(spark):
    df = Preparation(SPEC).fit(patients(spark)).transform(patients(spark))
    both = []
    for dense in (True, False):
        model = fit_model(df, ["age", "chol"], ["sex"], "num", "lr",
                          {"maxIter": 200, "regParam": 0.0, "elasticNetParam": 0.0}, scale_encoded=dense)
        both.append([r[0] for r in score(model, df, "id").orderBy("id").select("risk_probability").collect()])
    assert max(map(math.fabs, (a - b for a, b in zip(*both)))) < 1e-3


def test_a_seed_gives_one_model_whatever_the_partitions(spark):
    df = Preparation(SPEC).fit(patients(spark)).transform(patients(spark))
    both = []
    for parts in (1, 7):
        model = fit_model(df.repartition(parts), ["age", "chol"], ["sex"], "num", "rf",
                          {"numTrees": 5, "maxDepth": 4, "seed": 1}, key="id")
        both.append([r[0] for r in score(model, df, "id").orderBy("id").select("risk_probability").collect()])
    assert both[0] == both[1]


def test_partitions_follow_the_rows():
    assert [training_partitions(n) for n in (0, 8_000, 80_114, 10**6, 10**8, 10**12)] == [1, 1, 9, 64, 500, 5_000_000]


def test_a_row_scores_alike_in_the_batch_and_alone(spark):
    df = Preparation(SPEC).fit(patients(spark)).transform(patients(spark))
    model = fit_model(df, ["age", "chol", "ca"], ["sex"], "num", "lr", {"maxIter": 20}, key="id")
    batch = {r["id"]: r["risk_probability"] for r in score(model, df, "id").collect()}
    for i in (0, 17, 599):
        assert score(model, df.where(F.col("id") == i), "id").first()["risk_probability"] == batch[i]


def test_encoders_refuse_by_the_exact_count(spark):
    df = Preparation(SPEC).fit(patients(spark)).transform(patients(spark))
    with pytest.raises(ValueError, match="too many values"):
        fit_model(df, ["age"], ["sex"], "num", most=1)
