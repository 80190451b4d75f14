import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from riskframe.operators import evaluate, profile
from conftest import rows


def judged(spark):
    data = [(0, 0.0)] * 5 + [(0, 1.0)] * 2 + [(1, 1.0)] * 3 + [(1, 0.0)] + [(2, 1.0)]
    return spark.createDataFrame(data, "y int, prediction double")


def test_metrics_equal_the_evaluators(spark):
    df = judged(spark)
    got = evaluate.evaluate(df, "y").first()
    judge = MulticlassClassificationEvaluator(labelCol="y", predictionCol="prediction")
    for name, metric in (("accuracy", "accuracy"), ("f1", "f1"), ("weighted_precision", "weightedPrecision"),
                         ("weighted_recall", "weightedRecall")):
        assert got[name] == pytest.approx(judge.setMetricName(metric).evaluate(df))
    assert (got["n_classes"], got["n_rows"]) == (3, 12)
    assert rows(evaluate.accuracy(df, "y")) == [(pytest.approx(8 / 12),)]


def test_report_rows(spark):
    got = {r["row"]: r for r in evaluate.classification_report(judged(spark), "y").collect()}
    assert list(got) and set(got) == {"0", "1", "2", "accuracy", "macro avg", "weighted avg"}
    assert got["0"]["precision"] == pytest.approx(5 / 6) and got["0"]["support"] == 7
    assert got["2"]["precision"] == 0.0 and got["2"]["recall"] == 0.0
    assert got["macro avg"]["recall"] == pytest.approx((5 / 7 + 3 / 4 + 0) / 3)
    assert got["weighted avg"]["recall"] == pytest.approx(got["accuracy"]["f1"]) == pytest.approx(8 / 12)


def test_auc_with_ties_and_one_class(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.5), (1, 0.5), (0, 0.1)], "y int, s double")
    assert evaluate.auc(df, "y", "s") == pytest.approx(0.875)
    assert evaluate.auc(df.filter("y = 1"), "y", "s") is None
    assert evaluate.auc(df, "y", "s", curve="pr") == pytest.approx(0.5 * (1 + 1) / 2 + 0.5 * (1 + 2 / 3) / 2)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(i),) for i in range(31)] + [(None,)], "v double")
    got = profile.histogram(df, "v").orderBy("bin").collect()
    assert [r["n_rows"] for r in got] == [1] * 29 + [2]
    assert (got[0]["low"], got[-1]["high"]) == (0.0, 30.0)
    constant = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    got = profile.histogram(constant, "v", 4).orderBy("bin").collect()
    assert [r["n_rows"] for r in got] == [0, 0, 2, 0] and got[0]["low"] == 1.5
    assert profile.histogram(df.filter("v is null"), "v").count() == 0


def test_profile_small_tables(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("b", 0, 1.0), ("b", 0, 1.0), (None, 1, 1.0), ("a", None, 1.0)],
                               "c string, y int, v double")
    assert rows(profile.value_counts(df, "c")) == [("a", 2), ("b", 2)]
    assert sorted(rows(profile.crosstab(df, "c", "y"))) == [("a", 0, 1), ("b", 2, 0)]
    assert rows(profile.class_balance(df, "y", {0: "no"})) == [(0, "no", 2), (1, "1", 2)]
    assert rows(profile.overview(df, "y", ["c"])) == [(5, 1, 1, 2, 3)]
    assert dict((r[0], r[2]) for r in rows(profile.class_share(df, "y"))) == {None: 20.0, 0: 40.0, 1: 40.0}
    assert {r["r"] for r in profile.correlation(df, ["v", "y"]).filter("a = 'v'").collect()} == {None}
    long = profile.melt(df.limit(1), ["v"], ["c"])
    assert sorted(rows(long)) == [("c", "a", "categorical"), ("v", "1.0", "numeric")]


def test_describe_exact_and_approximate(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 5)] + [(None,), (float("nan"),)], "v double")
    assert rows(profile.describe_numeric(df, ["v"], exact=True)) == \
        [("v", 4, 2.5, 1.29, 1.0, 1.75, 2.5, 3.25, 4.0)]
    assert rows(profile.describe_numeric(df, ["v"]))[0][:5] == ("v", 4, 2.5, 1.29, 1.0)
