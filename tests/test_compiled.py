import duckdb
import pytest
from pyspark.sql import functions as F

from riskframe.operators.features import ClassWeights
from riskframe.plans import feature_importance, fit_model, score
from riskframe.plans.compiled import compile_model, name, number, replayed_importance, text, total
from test_boosting import patients

MODELS = {"lr": {"maxIter": 20}, "rf": {"numTrees": 6, "maxDepth": 4}, "gbt": {"maxIter": 4, "maxDepth": 3}}


def table(spark):
    """Numbers with missing cells, a category with quotes and nulls."""
    sex = F.when(F.col("id") % 3 == 0, "it's").when(F.col("id") % 3 == 1, "b")
    df = patients(spark).drop("w").withColumn("sex", sex)
    return ClassWeights("y").fit(df).transform(df)


@pytest.mark.parametrize("algo", MODELS)
@pytest.mark.parametrize("cats", [[], ["sex"]])
def test_every_engine_scores_alike(spark, algo, cats):
    df = table(spark)
    model = fit_model(df.fillna(0), ["a", "b", "c"], cats, "y", algo, MODELS[algo], key="id")
    new = df.withColumn("sex", F.when(F.col("id") % 10 == 0, "unseen").otherwise(F.col("sex")))
    compiled = compile_model(model)
    want = {r["id"]: r for r in score(model, new, "id").collect()}
    got = {r["id"]: r for r in compiled.score(new, "id").collect()}
    con = duckdb.connect()
    con.register("new_rows", new.toPandas())
    con.execute("CREATE VIEW sent AS SELECT * REPLACE (CAST(sex AS VARCHAR) AS sex) FROM new_rows")
    other = {r[0]: r for r in con.execute(compiled.sql("sent", "id", digits=6)).fetchall()}
    assert len(want) == len(got) == len(other) == 500
    assert sum(r["prediction"] is None for r in got.values()) == sum(r["prediction"] is None for r in want.values()) > 0
    for k, r in want.items():
        assert (r["prediction"], r["risk_band"]) == (got[k]["prediction"], got[k]["risk_band"]) == (other[k][1], other[k][3])
        if r["prediction"] is not None:
            assert got[k]["risk_probability"] == pytest.approx(r["risk_probability"], abs=1e-12)
            assert other[k][2] == pytest.approx(r["risk_probability"], abs=6e-7)


@pytest.mark.parametrize("algo", ["rf", "gbt"])
def test_importances_are_the_saved_gains(spark, algo):
    df = table(spark).fillna(0)
    model = fit_model(df, ["a", "b", "c"], ["sex"], "y", algo, MODELS[algo], key="id")
    want = {r["feature"]: r["importance"] for r in feature_importance(model, df).collect()}
    got = {r["feature"]: r["importance"] for r in replayed_importance(model, df).collect()}
    assert got.keys() == want.keys() and got == pytest.approx(want, abs=1e-9) and sum(got.values()) == pytest.approx(1)


def test_text():
    assert number(1) == "(1.0e0)" and number(-2.5e-7) == "(-2.5e-07)" and text("it's") == "'it''s'"
    assert total(["a", "b", "c"]) == "(a + (b + c))" and total([]) == "(0.0e0)"
    for bad in ("a b", "a;", "1a", 'a"'):
        with pytest.raises(ValueError):
            name(bad)
    with pytest.raises(ValueError):
        text("a\\b")
