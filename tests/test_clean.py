import math

import pytest
from pyspark.errors import PySparkException

from riskframe.operators import clean
from conftest import rows


def test_normalize_keeps_null_and_spells_booleans(spark):
    df = spark.createDataFrame([(" Male ", True), (None, False), ("FEMALE", None)], "s string, b boolean")
    out = clean.normalize_categoricals(df, ["s", "b", "absent"])
    assert out.columns == ["s", "b"]
    assert rows(out) == [("male", "true"), (None, "false"), ("female", None)]


def test_binarize_grades_and_null(spark):
    df = spark.createDataFrame([(0,), (1,), (4,), (-1,), (None,)], "num int")
    assert [r[0] for r in rows(clean.binarize_label(df, "num"))] == [0, 1, 1, 0, 0]
    assert [r[0] for r in rows(clean.binarize_label(df, "num", "keep"))] == [0, 1, 1, 0, None]
    assert [r[0] for r in rows(clean.binarize_label(df, "num", "drop"))] == [0, 1, 1, 0]
    assert dict(clean.binarize_label(df, "num").dtypes)["num"] == "int"
    with pytest.raises(ValueError):
        clean.binarize_label(df, "num", "other")


def test_cast_label_text(spark):
    df = spark.createDataFrame([("1",), ("yes",)], "y string")
    assert rows(clean.cast_label(df, "y", lenient=True)) == [(1,), (None,)]
    with pytest.raises(PySparkException):
        clean.cast_label(df, "y").collect()


def test_zero_to_null_keeps_type_and_other_columns(spark):
    df = spark.createDataFrame([(0, 0.0, 0), (3, 1.5, 0)], "a int, b double, c int")
    out = clean.zero_to_null(df, ["a", "b", "absent"])
    assert rows(out) == [(None, None, 0), (3, 1.5, 0)]
    assert out.dtypes == df.dtypes


def test_nan_to_null(spark):
    df = spark.createDataFrame([(math.nan, "x"), (1.0, "y")], "a double, s string")
    assert rows(clean.nan_to_null(df)) == [(None, "x"), (1.0, "y")]


def test_select_numeric_goes_by_type(spark):
    df = spark.createDataFrame([], "y int, s string, sh short, d decimal(5,2), a array<int>, b boolean, f float")
    assert clean.select_numeric(df, "y").columns == ["sh", "d", "f", "y"]


def test_detect_target_order_and_errors(spark):
    df = spark.createDataFrame([(1, 2)], "Outcome int, num int")
    assert clean.detect_target(df).columns == ["Outcome", "label"]
    with pytest.raises(ValueError, match="no target column"):
        clean.detect_target(spark.createDataFrame([(1,)], "a int"))
    with pytest.raises(ValueError, match="both"):
        clean.detect_target(spark.createDataFrame([(1, 2)], "target int, label int"))


def test_feature_split(spark):
    df = spark.createDataFrame([], "id long, y int, a double, sex string, b int, _class_weight double, fbs boolean")
    assert clean.split_feature_columns(df, "y", ["sex", "absent"], exclude=["id"]) == (["a", "b"], ["sex"])
    assert clean.feature_frame(df, "y", ["sex"], "id").columns == ["id", "y", "a", "b", "sex"]


def test_head_sample_is_by_key(spark):
    df = spark.range(100).repartition(7)
    assert [r[0] for r in rows(clean.head_sample(df, 3, "id"))] == [0, 1, 2]


def test_class_counts_refuses_continuous_label(spark):
    assert clean.class_counts(spark.createDataFrame([(1,), (None,), (1,)], "y int"), "y") == {None: 1, 1: 2}
    with pytest.raises(ValueError):
        clean.class_counts(spark.range(50), "id", max_classes=10)


def test_drop_and_filter(spark):
    df = spark.createDataFrame([(1, 2), (0, 3)], "y int, a int")
    assert clean.drop_if_present(df, ["a", "absent"]).columns == ["y"]
    assert rows(clean.filter_class(df, "y", 1)) == [(1, 2)]


def test_boolean_features_only_when_asked_for(spark):
    df = spark.createDataFrame([(1, True, True, 2.0), (2, None, False, None)],
                               "id long, flag boolean, y boolean, x double")
    assert clean.feature_frame(df, "y", key="id").columns == ["id", "y", "x"]
    got = clean.feature_frame(df, "y", key="id", booleans_as_int=True)
    assert [tuple(r) for r in got.orderBy("id").collect()] == [(1, True, 1, 2.0), (2, False, None, None)]
    assert got.columns == ["id", "y", "flag", "x"]
