"""Registered queries against their SQL twins, and the shape of their plans."""

import re

import pytest

import __spark_entry__ as contract
from riskcheck import ORACLES, QUERIES
from riskcheck.compare import compare, duck
from riskcheck.preparing import EVENT_SPEC
from riskcheck.registry import events_raw, risk_events, risk_lineitem
from riskframe.operators import clean, evaluate, features, impute, profile, sampling
from riskframe.plans import Preparation

# every operator of the inventory has a query named after it
IDS = ([f"a{i}" for i in (1, 2, 5, 6, 7, 8)] + [f"b{i}" for i in range(1, 12)] + [f"c{i}" for i in range(1, 7)]
       + [f"d{i}" for i in range(1, 11)] + [f"s{i}" for i in range(1, 11)] + [f"m{i}" for i in range(1, 8)]
       + [f"e{i}" for i in range(1, 6)] + [f"p{i}" for i in range(1, 10)])


def test_contract_covers_the_inventory(spark):
    names = contract.queries()
    assert set(contract.oracle_sql()) <= set(names)
    for i in IDS:
        assert any(n.startswith(f"{i}_") for n in names), i
    assert contract.entry(spark).count() == 2


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, sf_dir, name):
    ok, note = compare(spark, con, name, sf_dir)
    assert ok, note


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_preparing_is_one_projection_over_a_pruned_scan(spark, sf_dir):
    df = events_raw(spark, sf_dir)
    plan = plan_of(Preparation(EVENT_SPEC).fit(df).transform(df))
    assert "Exchange" not in plan and "Join" not in plan
    scan = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "user_id" not in scan and "ts:" not in scan


def test_splitting_and_noise_do_not_shuffle(spark, sf_dir):
    df = risk_events(spark, sf_dir)
    train, test = sampling.stratified_split(df, "y", "event_id")
    noisy = sampling.add_noise(sampling.replicate(df, 3), ["value"], "event_id")
    exact, _ = sampling.stratified_split(df, "y", "event_id", exact=True)
    for part in (train, test, noisy, exact):
        assert "Exchange" not in plan_of(part)


def test_class_filter_reaches_the_scan(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/labels.parquet")
    assert "PushedFilters: [IsNotNull(quality), EqualTo(quality,1)]" in \
        plan_of(clean.filter_class(df, "quality", 1))


def test_no_cross_join_and_no_global_window(spark, sf_dir):
    events, items = risk_events(spark, sf_dir), risk_lineitem(spark, sf_dir)
    judged = events.selectExpr("y", "double(value > 60) prediction")
    for df in (impute.ClassMedianImputer(("k",), "y").fit(events).transform(events),
               features.ClassWeights("y").fit(items).transform(items),
               profile.describe_numeric(items, ["l_tax"]), profile.correlation(items, ["l_tax", "y"]),
               profile.histogram(events, "value"), profile.crosstab(events, "event_type", "y"),
               evaluate.evaluate(judged, "y"), evaluate.classification_report(judged, "y")):
        plan = plan_of(df)
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan and "Window" not in plan


def test_copies_are_cut_before_the_shuffle(spark, monkeypatch, sf_dir):
    """Equal donors are limited on the map side, so copies never fill one task."""
    from riskframe.operators import neighbors
    seen = []
    real = neighbors.stored
    monkeypatch.setattr(neighbors, "stored", lambda df, name: seen.append(plan_of(df)) or real(df, name))
    neighbors.build_index(risk_events(spark, sf_dir), "event_id", ["k"], 3)
    cut = next(plan for plan in seen if "WindowGroupLimit" in plan)
    assert cut.count("WindowGroupLimit") == 2
    assert "Partial" in cut and cut.index("Final") < cut.index("Partial")


def test_all_queries_are_named_and_callable():
    assert all(re.fullmatch(r"[a-z][a-z0-9_]*", n) and callable(q) for n, q in QUERIES.items())
