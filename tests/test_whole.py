import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.functions import normal
from riskframe.operators.boosting import BoostingParams
from riskframe.plans.explore import explore
from riskframe.plans.trial import run_trial
from riskframe.spec import DatasetSpec

FEW = BoostingParams(rounds=10, depth=3, rate=0.3, rows=0.8, columns=0.8, gamma=1.0, l1=0.5, l2=1.0)


def hearts(spark, n=300):
    z = lambda name: normal(5, F.col("id"), name)
    df = spark.range(n).select(
        "id", F.round(50 + 9 * z("age"), 3).alias("age"), F.round(230 + 50 * z("chol"), 3).alias("chol"),
        F.round(150 + 20 * z("thalach"), 3).alias("thalach"), F.round(F.abs(z("old")), 3).alias("oldpeak"),
        F.round(130 + 18 * z("bps"), 3).alias("trestbps"), (F.col("id") % 3 == 0).alias("fbs"), F.lit("x").alias("name"))
    sick = F.col("age") / 10 + F.col("oldpeak") * 2 + z("noise") > 8
    df = df.withColumn("num", F.when(sick, F.col("id") % 4 + 1).otherwise(0))
    return df.withColumn("chol", F.when(F.col("id") % 9 != 0, F.col("chol")))


def test_trial_learns_from_training_rows_only(spark):
    df = hearts(spark)
    done = run_trial(df, "id", "num", params=FEW)
    y = {r["id"]: int(r["num"] > 0) for r in df.collect()}
    told = {r["id"]: r for r in done.predictions.collect()}
    for cls in (0, 1):
        assert sum(y[i] == cls for i in told) == int(0.2 * sum(v == cls for v in y.values()) + 0.5)
    own = {int(r["key"]): r for r in done.training.collect() if "#" not in r["key"]}
    assert not set(own) & set(told) and len(own) + len(told) == len(y)
    sizes = {r["num"]: r["count"] for r in done.training.groupBy("num").count().collect()}
    assert sizes[0] == sizes[1]
    scaled = np.array([[r[c] for c in done.features] for r in own.values()])
    assert len(done.features) == 14 and np.allclose(scaled.mean(0), 0) and np.allclose(scaled.std(0), 1)
    good = sum(told[i]["prediction"] == y[i] for i in told) / len(told)
    report = {r["row"]: r for r in done.report.collect()}
    assert report["accuracy"]["precision"] == pytest.approx(good) and good > 0.7
    assert report["1"]["support"] == sum(y[i] for i in told)
    again = {r["id"]: r["risk_probability"] for r in done.score(df.drop("num"), "id").collect()}
    assert len(again) == len(y) and all(again[i] == pytest.approx(told[i]["risk_probability"]) for i in told)


def test_trial_fills_from_training_neighbours(spark):
    df = hearts(spark)
    done = run_trial(df, "id", "num", derive=lambda d: d.select("id", "num", "age", "oldpeak", "chol"), params=FEW)
    rows = {r["id"]: (r["age"], r["oldpeak"], r["chol"]) for r in df.collect()}
    train = sorted(set(rows) - {r["id"] for r in done.predictions.collect()})
    full = [i for i in train if rows[i][2] is not None]
    near = lambda i: sorted(full, key=lambda j: ((rows[i][0] - rows[j][0]) ** 2 + (rows[i][1] - rows[j][1]) ** 2, j))[:5]
    filled = {i: rows[i][2] if rows[i][2] is not None else np.mean([rows[j][2] for j in near(i)]) for i in train}
    mean, sd = np.mean(list(filled.values())), np.std(list(filled.values()))
    got = {int(r["key"]): r["chol_std"] for r in done.training.collect() if "#" not in r["key"]}
    assert all(got[i] == pytest.approx((filled[i] - mean) / sd) for i in train)


def test_explore_profiles_one_prepared_table(spark):
    spec = DatasetSpec(label="num", key="id", binarize=True, categorical=("name",), interactions=(("age", "chol"),))
    seen = explore(hearts(spark).drop("fbs"), spec)
    assert "age_x_chol" in seen.engineered and seen.categorical == ("name",)
    top = seen.overview().first()
    assert (top["n_rows"], top["n_numeric"], top["n_categorical"]) == (300, len(seen.numeric), 1)
    assert {r["feature"] for r in seen.describe().collect()} == set(seen.numeric)
    assert sum(r["n_rows"] for r in seen.distribution("age", 7).collect()) == 300
    assert {r["a"] for r in seen.correlation().collect()} == {"age", "chol", "thalach", "oldpeak", "trestbps", "num"}
    assert sum(r["n_rows"] for r in seen.balance().collect()) == 300 and seen.sample().count() == 10
    assert seen.breakdown("name").count() == 1
    with pytest.raises(ValueError, match="no feature"):
        seen.distribution("id")
