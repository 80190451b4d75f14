"""Queries: models, scoring, saved models.

The queries ending in ``_values`` fit models that SQL can fit too and compare every score.
For the large ones, those ending in ``_sound`` check what surrounds the fitted numbers:
which rows are scored, and that band, prediction and probability agree.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from riskcheck.fits import GINI, LINE_FEATURES, LINES, newton, penalised, told
from riskcheck.registry import query, rounded, sql_uniform, table
from riskframe.operators.boosting import BoostingParams, fit_boosted, score_boosted
from riskframe.operators.features import ClassWeights
from riskframe.operators.sampling import stratified_split
from riskframe.plans import (Preparation, build_stages, feature_importance, fit_model, score,
                             train_and_evaluate)
from riskframe.plans.compiled import compile_boosted, compile_model, replayed_importance
from riskframe.plans.train import SLOW_BOOSTING
from riskframe.sources import load_model, save_model, scratch_path
from riskframe.spec import DatasetSpec

MODEL_SPEC = DatasetSpec(label="y", key="event_id", zero_as_missing=("k",), categorical=("weekday",),
                         interactions=(("value", "k"),), log_columns=("value",))


def model_events(spark, sf):
    """Events with the error flag as label and the weekday as a category."""
    return table(spark, sf, "events").select(
        "event_id", (F.col("event_type") == "error").cast("int").alias("y"), "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.date_format("ts", "EEEE").alias("weekday"))


def sides(spark, sf):
    """Preparation fitted on the train side, both sides prepared, numeric and categorical features."""
    train, test = stratified_split(model_events(spark, sf), "y", "event_id")
    prepared = Preparation(MODEL_SPEC).fit(train)
    train, test = prepared.transform(train), prepared.transform(test)
    return prepared, train, test, *prepared.feature_columns(train)


def fitted(spark, sf, algo, params=None):
    """The preparation, a model on its train side, and both sides."""
    prepared, train, test, numeric, cats = sides(spark, sf)
    return prepared, fit_model(train, numeric, cats, "y", algo, params, key="event_id"), train, test


def predictions(spark, sf, algo, params=None):
    _, model, _, test = fitted(spark, sf, algo, params)
    return score(model, test, "event_id")


def sound(scored):
    """event_id and whether a row's band, prediction and probability agree, or are all null."""
    p, y, band = F.col("risk_probability"), F.col("prediction"), F.col("risk_band")
    agree = (p.between(0, 1) & y.isin(0.0, 1.0) & (F.abs(y - p) <= 0.5 + 1e-9)
             & (band == F.when(y == 1, "HIGH RISK").otherwise("LOW RISK")))
    return scored.select("event_id", F.coalesce(agree, p.isNull() & y.isNull() & band.isNull()).alias("sound"))


TEST_ROWS = f"SELECT event_id, TRUE AS sound FROM events WHERE {sql_uniform(42, 'event_id')} < 0.2"


@query("m1_build_stages")
def _(spark, sf):
    _, train, test, numeric, cats = sides(spark, sf)
    model = build_stages(numeric, cats, "y", "unknown name").fit(train)
    return model.transform(test).select("event_id", "y", "prediction")


@query("m1_build_stages_sound", TEST_ROWS)
def _(spark, sf):
    _, train, test, numeric, cats = sides(spark, sf)
    return sound(score(build_stages(numeric, cats, "y", "unknown name").fit(train), test, "event_id"))


MODELS = {"m2_random_forest": ("rf", None), "m3_gbt": ("gbt", None), "m4_logreg": ("lr", None)}


def _register(name, algo, params):
    query(name)(lambda spark, sf: predictions(spark, sf, algo, params))
    query(f"{name}_sound", TEST_ROWS)(lambda spark, sf: sound(predictions(spark, sf, algo, params)))


for _name, (_algo, _params) in MODELS.items():
    _register(_name, _algo, _params)


def boosted(spark, sf):
    """The slow boosting variant on the prepared numeric features."""
    _, train, test, numeric, _ = sides(spark, sf)
    return score_boosted(fit_boosted(train, numeric, "y", "event_id", "_class_weight", SLOW_BOOSTING), test, "event_id")


query("m5_gbt_regularised")(boosted)
query("m5_gbt_regularised_sound", TEST_ROWS)(lambda spark, sf: sound(boosted(spark, sf)))


# ---- models that SQL fits too ---------------------------------------------------------------

def weighted_lines(spark, sf):
    """Line items numbered by order and line, the return flag as label, classes balanced."""
    lines = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line_id"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"), *(F.col(c).cast("double").alias(c) for c in LINE_FEATURES))
    return ClassWeights("y").fit(lines).transform(lines)


ONE_FOREST = {"numTrees": 1, "maxDepth": 2, "maxBins": 64, "featureSubsetStrategy": "all", "bootstrap": False,
              "minInstancesPerNode": 1, "seed": 1}
ONE_ROUND = {"maxIter": 1, "maxDepth": 2, "maxBins": 64, "stepSize": 0.1, "subsamplingRate": 1.0, "minInstancesPerNode": 1,
             "seed": 1}
FIRST_TREE = BoostingParams(rounds=1, depth=2, rate=0.3, rows=1.0, columns=1.0, gamma=0.01, l1=0.5, l2=1.0)


def one_tree(spark, sf, algo):
    lines = weighted_lines(spark, sf)
    return lines, fit_model(lines, LINE_FEATURES, [], "y", algo, ONE_FOREST if algo == "rf" else ONE_ROUND, key="line_id")


@query("m2_forest_values", f"WITH {LINES},\n{GINI}\n{told('a / b', 'leaf', 'line_id')}")
def _(spark, sf):
    lines, model = one_tree(spark, sf, "rf")
    return rounded(score(model, lines, "line_id"))


@query("m2_forest_compiled_values", f"WITH {LINES},\n{GINI}\n{told('a / b', 'leaf', 'line_id')}")
def _(spark, sf):
    lines, model = one_tree(spark, sf, "rf")
    return rounded(compile_model(model).score(lines, "line_id"))


GBT_VALUES = f"WITH {LINES},\n{GINI}\n{told('1 / (1 + exp(-2 * (2 * a / b - 1)))', 'leaf', 'line_id')}"


@query("m3_gbt_values", GBT_VALUES)
def _(spark, sf):
    lines, model = one_tree(spark, sf, "gbt")
    return rounded(score(model, lines, "line_id"))


@query("m3_gbt_compiled_values", GBT_VALUES)
def _(spark, sf):
    lines, model = one_tree(spark, sf, "gbt")
    return rounded(compile_model(model).score(lines, "line_id"))


STEP = f"{FIRST_TREE.rate} * sign(a) * greatest(abs(a) - {FIRST_TREE.l1}, 0) / (b + {FIRST_TREE.l2})"
PENALISED = penalised(FIRST_TREE.l1, FIRST_TREE.l2, FIRST_TREE.gamma, FIRST_TREE.least_hessian)
FIRST_VALUES = f"WITH {LINES},\n{PENALISED}\n{told(f'1 / (1 + exp({STEP}))', 'leaf', 'line_id')}"


def first_tree(spark, sf):
    lines = weighted_lines(spark, sf)
    return lines, fit_boosted(lines, LINE_FEATURES, "y", "line_id", "_class_weight", FIRST_TREE)


@query("m5_first_tree_values", FIRST_VALUES)
def _(spark, sf):
    lines, model = first_tree(spark, sf)
    return rounded(score_boosted(model, lines, "line_id"))


@query("m5_first_tree_compiled_values", FIRST_VALUES)
def _(spark, sf):
    lines, model = first_tree(spark, sf)
    return rounded(compile_boosted(model).score(lines, "line_id"))


@query("m5_first_tree_splits", f"""WITH {LINES},\n{PENALISED}
SELECT CAST(node AS INTEGER) AS node, CASE feature WHEN 0 THEN 'l_quantity' WHEN 1 THEN 'l_discount' ELSE 'l_tax' END AS feature,
  value AS threshold, round(gain, 6) AS gain FROM (SELECT * FROM best1 UNION ALL SELECT * FROM best2)""")
def _(spark, sf):
    _, model = first_tree(spark, sf)
    found = [(n["node"], model.features[n["feature"]], n["threshold"], n["gain"]) for n in model.nodes if n["feature"] is not None]
    return rounded(spark.createDataFrame(found, "node int, feature string, threshold double, gain double"))


@query("m7_importance_values", f"""WITH {LINES},\n{GINI},
gained AS (SELECT feature AS slot, sum(gain) AS gain FROM (SELECT * FROM best1 UNION ALL SELECT * FROM best2) GROUP BY feature)
SELECT feature, round(coalesce(gain, 0) / sum(gain) OVER (), 6) AS importance
FROM (SELECT unnest([0, 1, 2]) AS slot, unnest(['l_quantity', 'l_discount', 'l_tax']) AS feature) LEFT JOIN gained USING (slot)""")
def _(spark, sf):
    lines, model = one_tree(spark, sf, "rf")
    return rounded(replayed_importance(model, lines).select("feature", "importance"))


PLAIN = {"regParam": 0.0, "elasticNetParam": 0.0, "tol": 1e-12, "maxIter": 300}
#: Events with two measurements as numbers of about 1, and the train side's balanced weights.
EVENTS_XY = f"""ev AS (SELECT event_id AS id, CAST(event_type = 'error' AS DOUBLE) AS y, value / 100 AS x1,
  coalesce(CAST(props->>'$.k' AS INTEGER), 0) / 100 AS x2, {sql_uniform(42, 'event_id')} < 0.2 AS held FROM events),
counted AS (SELECT count(*) AS n, sum(y) AS n1 FROM ev WHERE NOT held),
train AS (SELECT ev.*, CASE WHEN y = 1 THEN n / (2 * n1) ELSE n / (2 * (n - n1)) END AS w FROM ev, counted WHERE NOT held),
{newton('train')}"""
LINEAR = "1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2)))"
LINEAR_TEST = f"WITH {EVENTS_XY}\n{told(LINEAR, 'ev, fit WHERE held')}"
LINEAR_ALL = f"WITH {EVENTS_XY}\n{told(LINEAR, 'ev, fit')}"


def linear_sides(spark, sf):
    events = model_events(spark, sf).select("event_id", "y", "value", F.coalesce("k", F.lit(0)).alias("k"))
    train, test = stratified_split(events, "y", "event_id")
    return events, ClassWeights("y").fit(train).transform(train), test


@query("m1_build_stages_values", LINEAR_TEST)
def _(spark, sf):
    _, train, test = linear_sides(spark, sf)
    return rounded(score(build_stages(["value", "k"], [], "y", "unknown name", PLAIN).fit(train), test, "event_id"))


@query("m4_logreg_values", LINEAR_TEST)
def _(spark, sf):
    _, train, test = linear_sides(spark, sf)
    return rounded(score(fit_model(train, ["value", "k"], [], "y", "lr", PLAIN, key="event_id"), test, "event_id"))


@query("m4_logreg_compiled_values", LINEAR_TEST)
def _(spark, sf):
    _, train, test = linear_sides(spark, sf)
    model = compile_model(fit_model(train, ["value", "k"], [], "y", "lr", PLAIN, key="event_id"))
    return rounded(model.score(test, "event_id"))


@query("m6_score_batch_values", LINEAR_ALL)
def _(spark, sf):
    events, train, _ = linear_sides(spark, sf)
    return rounded(score(fit_model(train, ["value", "k"], [], "y", "lr", PLAIN, key="event_id"), events.drop("y"), "event_id"))


def batch(spark, sf):
    """All events scored by a model with the preparation it was trained with."""
    prepared, model, _, _ = fitted(spark, sf, "lr")
    return score(model, prepared.transform(model_events(spark, sf).drop("y")), "event_id")


@query("m6_score_batch")
def _(spark, sf):
    return batch(spark, sf)


@query("m6_score_batch_sound", "SELECT event_id, TRUE AS sound FROM events")
def _(spark, sf):
    return sound(batch(spark, sf))


@query("m7_feature_importance")
def _(spark, sf):
    _, model, train, _ = fitted(spark, sf, "rf")
    return feature_importance(model, train)


@query("m7_importance_slots", """WITH slots AS (
  SELECT unnest(['value', 'k', 'value_x_k', 'value_log', 'weekday_ohe___unknown']) AS feature
  UNION SELECT 'weekday_ohe_' || lower(dayname(ts)) FROM events)
SELECT feature, CAST(1.0 AS DOUBLE) AS total FROM slots""")
def _(spark, sf):
    _, model, train, _ = fitted(spark, sf, "rf")
    found = feature_importance(model, train)
    total = found.agg(F.round(F.sum("importance"), 6).alias("total"))
    return found.select("feature").join(F.broadcast(total))      # one row


@query("a6_save_model")
def _(spark, sf):
    _, model, _, test = fitted(spark, sf, "lr")
    save_model(model, scratch_path(spark, "model"))
    return score(model, test, "event_id")


@query("a7_load_model")
def _(spark, sf):
    _, model, _, test = fitted(spark, sf, "lr")
    path = save_model(model, scratch_path(spark, "model"))
    return score(load_model(path), test, "event_id")


@query("a7_reload_scores_alike", TEST_ROWS.replace("TRUE AS sound", "TRUE AS alike"))
def _(spark, sf):
    """A model that was saved and loaded scores every test row as before."""
    _, model, _, test = fitted(spark, sf, "lr")
    path = save_model(model, scratch_path(spark, "model"))
    again = score(load_model(path), test, "event_id").select(
        "event_id", F.col("risk_probability").alias("again"), F.col("risk_band").alias("band"))
    return score(model, test, "event_id").join(again, "event_id").select(
        "event_id", (F.col("risk_probability").eqNullSafe(F.col("again"))
                     & F.col("risk_band").eqNullSafe(F.col("band"))).alias("alike"))


@query("train_and_evaluate")
def _(spark, sf):
    _, _, metrics = train_and_evaluate(model_events(spark, sf), MODEL_SPEC, "lr")
    return spark.createDataFrame(sorted((k, float(v)) for k, v in metrics.items()),
                                 "metric string, value double")
