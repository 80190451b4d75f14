import math

import pytest

from riskframe.operators import features
from conftest import rows


def test_interactions_skip_absent(spark):
    df = spark.createDataFrame([(2, 3.0), (None, 1.0)], "a int, b double")
    out, added = features.add_interactions(df, [("a", "b"), ("a", "absent")])
    assert added == ["a_x_b"] and rows(out) == [(2, 3.0, 6.0), (None, 1.0, None)]


def test_log1p_at_and_below_minus_one(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,), (math.e - 1,), (-5.0,)], "insulin double")
    out, added = features.add_log1p(df)
    assert added == ["insulin_log"]
    assert [r[1] for r in rows(out)] == [0.0, None, pytest.approx(1.0), None]


def test_heart_features(spark):
    df = spark.createDataFrame([(50, 250, 100, 2.0, 150), (0, 240, 120, 1.0, 140), (40, None, None, None, None)],
                               "age int, chol int, thalach int, oldpeak double, trestbps int")
    out = features.add_heart_features(df).drop("age", "chol", "thalach", "oldpeak", "trestbps")
    assert out.columns == ["chol_age_ratio", "thalach_age_ratio", "oldpeak_sq", "high_bp", "high_chol",
                           "low_hr", "age_oldpeak", "chol_oldpeak"]
    assert rows(out) == [(5.0, 2.0, 4.0, 1, 1, 1, 100.0, 500.0), (None, None, 1.0, 0, 0, 0, 0.0, 240.0),
                         (None, None, None, 0, 0, 0, None, None)]


def test_flag_operator_is_checked(spark):
    with pytest.raises(ValueError):
        features.add_flags(spark.range(1), {"f": ("id", ">=", 1)})


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)], "y int")
    model = features.ClassWeights("y").fit(df)
    assert model.weights == {0: 4 / 6, 1: 2.0}
    unseen = spark.createDataFrame([(0,), (2,), (None,)], "y int")
    assert [r[1] for r in rows(model.transform(unseen))] == [4 / 6, 1.0, 1.0]


def test_index_order_and_unknown(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "s string")
    got = dict(rows(features.string_index(df, "s")))
    assert got == {"c": 0.0, "a": 1.0, "b": 2.0, None: 3.0}
    encoded = features.one_hot(df, "s").select("s", "s_ohe").collect()
    assert {r[0]: (r[1].size, list(r[1].indices)) for r in encoded}[None] == (4, [3])


def test_index_refuses_wide_columns(spark):
    df = spark.range(3000).selectExpr("string(id) s")
    with pytest.raises(ValueError, match="too many values"):
        features.string_index(df, "s")


def test_assemble_leaves_incomplete_rows_out_and_counts_them(spark):
    df = spark.createDataFrame([(1.0, 2), (None, 2), (math.nan, 1)], "a double, b int")
    assert features.assemble(df, ["a", "b"]).count() == 1
    assert rows(features.incomplete_rows(df, ["a", "b"])) == [(1, 2)]


def test_standardize_constant_and_deviation(spark):
    df = spark.createDataFrame([(1.0, 5), (3.0, 5)], "a double, c int")
    out = rows(features.Standardizer(("a", "c")).fit(df).transform(df).select("a_std", "c_std"))
    assert out == [(pytest.approx(-1 / math.sqrt(2)), 0.0), (pytest.approx(1 / math.sqrt(2)), 0.0)]
    pop = rows(features.Standardizer(("a",), ddof=0).fit(df).transform(df).select("a_std"))
    assert pop == [(-1.0,), (1.0,)]
