import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import impute
from conftest import rows


def test_class_median_falls_back(spark):
    df = spark.createDataFrame(
        [(0, 10.0, None), (0, 20.0, None), (0, None, None), (1, None, None), (2, None, None), (None, None, None)],
        "y int, a double, b int")
    model = impute.ClassMedianImputer(("a", "b", "absent"), "y", exact=True).fit(df)
    out = rows(model.transform(df))
    assert [r[1] for r in out] == [10.0, 20.0, 15.0, 15.0, None, None]     # class 1: overall median
    assert [r[2] for r in out] == [0.0] * 4 + [None] * 2                   # no value at all: 0
    unlabelled = rows(model.transform(df.drop("y")))
    assert [r[0] for r in unlabelled] == [10.0, 20.0, 15.0, 15.0, 15.0, 15.0]
    assert [r[1] for r in rows(model.transform(df, use_label=False))] == [10.0, 20.0] + [15.0] * 4


def test_class_median_per_class(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 10.0), (1, 30.0), (0, None), (1, None)], "y int, a double")
    for exact, want in ((True, {0: 2.0, 1: 20.0}), (False, {0: 1.0, 1: 10.0})):
        model = impute.ClassMedianImputer(("a",), "y", exact=exact).fit(df)
        assert model.medians["a"] == want


def test_mean_rounds_half_even_and_promotes(spark):
    df = spark.createDataFrame([(1, 0.5), (2, math.nan), (None, None)], "i int, d double")
    model = impute.MeanImputer().fit(df)
    assert model.values == {"i": 1.5, "d": 0.5}
    assert rows(model.transform(df)) == [(1.0, 0.5), (2.0, 0.5), (1.5, 0.5)]
    kept = model.transform(df, keep_type=True)
    assert rows(kept)[2] == (1, 0.5) and kept.dtypes == df.dtypes


def test_mean_of_nothing_stays_null(spark):
    df = spark.createDataFrame([(None,)], "a double")
    assert rows(impute.MeanImputer().fit(df).transform(df)) == [(None,)]


def test_mode_ties_and_nulls(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", "x"), ("a", None), (None, None)], "c string, d string")
    assert impute.ModeImputer(("c", "d")).fit(df).values == {"c": "a", "d": "x"}
    assert impute.ModeImputer(("c", "d"), nulls_compete=True).fit(df).values == {"c": "a"}


def test_median_drops_empty_columns(spark):
    df = spark.createDataFrame([(1, None), (2, None), (None, None)], "a int, b double")
    out = impute.MedianImputer(exact=True).fit(df).transform(df)
    assert out.columns == ["a"] and rows(out) == [(1.0,), (2.0,), (1.5,)]


def test_field_lookup_and_report(spark):
    assert impute.field_range("Blood_Pressure") == impute.KNOWN_FIELDS["bloodpressure"]
    assert impute.field_range("whatever") == impute.UNKNOWN_FIELD
    df = spark.createDataFrame([(10, "male"), (None, None), (500, "other")], "Age int, sex string")
    assert rows(impute.apply_defaults(df, ["Age", "sex"]))[1] == (35, "male")
    assert rows(impute.range_report(df, ["Age", "sex"])) == [("Age", 1, 1, 1), ("sex", 1, 1, 1)]


def brute_knn(train, rows_, k):
    """Nan-Euclidean nearest-donor means, one row at a time."""
    train = np.array(train, dtype=float)
    means = np.nanmean(train, axis=0)
    out = []
    for row in np.array(rows_, dtype=float):
        filled = row.copy()
        for j in np.nonzero(np.isnan(row))[0]:
            both = ~np.isnan(train) & ~np.isnan(row)
            gap = np.where(both, train - row, 0.0)
            with np.errstate(all="ignore"):
                dist = (gap ** 2).sum(1) * train.shape[1] / both.sum(1)
            usable = np.isfinite(dist) & ~np.isnan(train[:, j])
            order = [i for i in np.argsort(dist, kind="stable") if usable[i]][:k]
            filled[j] = train[order, j].mean() if order else means[j]
        out.append(filled)
    return np.array(out)


@pytest.mark.parametrize("chunk, cells", [(16_384, 4_096), (7, 4_096), (16_384, 8), (7, 8), (16_384, 1), (7, 2)])
def test_knn_equals_brute_force(spark, monkeypatch, chunk, cells):
    from riskframe.operators import neighbors
    monkeypatch.setattr(neighbors, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(neighbors, "MAX_CELLS", cells)
    monkeypatch.setattr(neighbors.build_index, "__defaults__", (20, 42))
    rng = np.random.default_rng(3)
    data = rng.normal(size=(240, 4)).round(2)
    data[:80] = data[0]                                  # a third are copies of one row
    data[rng.random(data.shape) < 0.2] = np.nan
    data[5] = np.nan
    given = [(i, *[None if math.isnan(v) else float(v) for v in r]) for i, r in enumerate(data)]
    df = spark.createDataFrame(given, "id long, a double, b double, c double, d double").repartition(3)
    out = impute.KnnImputer(("a", "b", "c", "d"), "id", k=5).fit(df).transform(df)
    got = np.array(sorted(rows(out)))[:, 1:]
    assert got == pytest.approx(brute_knn(data, data, 5), abs=1e-9)


def test_knn_over_many_coordinates(spark):
    rng = np.random.default_rng(4)
    data = rng.normal(size=(60, 70)).round(2)
    data[rng.random(data.shape) < 0.05] = np.nan
    names = [f"c{i}" for i in range(70)]
    given = [(i, *[None if math.isnan(v) else float(v) for v in r]) for i, r in enumerate(data)]
    df = spark.createDataFrame(given, "id long, " + ", ".join(f"{c} double" for c in names))
    out = impute.KnnImputer(tuple(names), "id", k=3).fit(df).transform(df)
    assert np.array(sorted(rows(out)))[:, 1:] == pytest.approx(brute_knn(data, data, 3), abs=1e-9)


def test_knn_applies_to_unseen_rows_and_drops_empty(spark):
    train = spark.createDataFrame([(1, 0.0, 1.0, None), (2, 1.0, 3.0, None), (3, 9.0, 50.0, None)],
                                  "id long, a double, b double, c double")
    test = spark.createDataFrame([(7, 0.4, None, None), (8, None, None, None)],
                                 "id long, a double, b double, c double")
    out = impute.KnnImputer(("a", "b", "c"), "id", k=2).fit(train).transform(test)
    assert sorted(rows(out)) == [(7, 0.4, 2.0), (8, pytest.approx(10 / 3), 18.0)]


def test_knn_asks_a_cell_once_for_all_targets(spark, monkeypatch):
    """A query goes to a cell once, not once for each coordinate it lacks, and what groups find is narrow."""
    from riskframe.operators import neighbors
    seen, real = {}, neighbors.stored
    monkeypatch.setattr(neighbors, "stored", lambda df, name: seen.setdefault(name, real(df, name)))
    gaps = spark.range(40).select("id", *(F.when((F.col("id") * 7 + i) % 3 != 0, F.col("id") * (i + 1) % 11).cast("double").alias(f"x{i}")
                                          for i in range(9)))
    model = impute.KnnImputer(tuple(f"x{i}" for i in range(9)), "id", 2).fit(gaps)
    assert model.transform(gaps).where(" or ".join(f"x{i} is null" for i in range(9))).count() == 0
    visits, near = seen["visits"], seen["near"]
    assert visits.groupBy("query_key", "cell").count().where("count > 1").isEmpty()
    assert visits.selectExpr("max(size(targets))").first()[0] > 1
    assert not [c for c in near.columns if c.startswith("d") and c[1:2] == "x"]
