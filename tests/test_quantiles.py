import numpy as np
import pytest

from riskframe.operators import quantiles
from riskframe.operators.quantiles import OVERALL, exact_quantiles


@pytest.fixture
def tiny_fetch(monkeypatch):
    monkeypatch.setattr(quantiles, "FETCH_ROWS", 20)
    monkeypatch.setattr(quantiles, "BINS", 8)


def frame(spark):
    rng = np.random.default_rng(7)
    heavy = rng.lognormal(0, 3, 1500)
    copies = np.where(rng.random(1500) < 0.35, 5.0, rng.normal(5, 2, 1500))
    group = rng.integers(0, 2, 1500)
    data = [(int(g), float(h), float(c), None if i % 3 else float(i))
            for i, (g, h, c) in enumerate(zip(group, heavy, copies))]
    return spark.createDataFrame(data, "g int, heavy double, copies double, holes double").repartition(5), data


def test_exact_equals_numpy_when_passes_narrow(spark, tiny_fetch):
    df, data = frame(spark)
    probs = [0.0, 0.1, 0.5, 0.77, 1.0]
    found = exact_quantiles(df, ["heavy", "copies", "holes"], probs, by="g")
    for g in (0, 1, OVERALL):
        for i, c in enumerate(["heavy", "copies", "holes"], 1):
            values = [r[i] for r in data if (g is OVERALL or r[0] == g) and r[i] is not None]
            assert found[g, c] == pytest.approx(np.quantile(values, probs), rel=1e-12)


def test_exact_without_groups_and_without_values(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (float("nan"), None)], "a double, b double")
    assert exact_quantiles(df, ["a", "b"], [0.5]) == {(OVERALL, "a"): [1.5], (OVERALL, "b"): [None]}


def test_wrong_guess_falls_back(spark, tiny_fetch, monkeypatch):
    df, data = frame(spark)
    real = quantiles._stats

    def misleading(*args):
        stats = real(*args)
        return {k: {**s, "near": [1e9] * len(s["near"])} for k, s in stats.items()}
    monkeypatch.setattr(quantiles, "_stats", misleading)
    assert exact_quantiles(df, ["heavy"], [0.5])[OVERALL, "heavy"][0] == \
        pytest.approx(np.median([r[1] for r in data]))


def test_infinite_values_are_refused(spark):
    df = spark.createDataFrame([(float("inf"),), (1.0,)], "a double")
    with pytest.raises(ValueError, match="finite"):
        exact_quantiles(df, ["a"], [0.5])


def test_approximate_is_close(spark):
    df = spark.range(1, 1001).selectExpr("double(id) a")
    assert quantiles.quantiles(df, ["a"], [0.5])[OVERALL, "a"][0] == pytest.approx(500, abs=1)
