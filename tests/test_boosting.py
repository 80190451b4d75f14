import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.functions import normal
from riskframe.operators import boosting
from riskframe.operators.boosting import (BoostedTrees, BoostingParams, fit_boosted, quantile_cuts,
                                          score_boosted)
from riskframe.plans.compiled import compile_boosted

SMALL = BoostingParams(rounds=3, depth=3, rate=0.3, rows=1.0, columns=1.0, gamma=0.2, l1=0.5, l2=1.0, bins=16)


def patients(spark, n=500):
    """Numbers of few values, some missing, whose sum decides the label with some noise."""
    z = normal(3, F.col("id"), "z")
    a, b = (F.col("id") % 11).cast("double"), F.floor(normal(4, F.col("id"), "b") * 2)
    return spark.range(n).select(
        "id", a.alias("a"), F.when(F.col("id") % 7 != 0, b).cast("int").alias("b"),
        F.when(F.col("id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("id") % 3).alias("c"),
        (F.when(F.col("id") % 7 == 0, 2).otherwise(b) + a / 3 + z > 2.5).cast("int").alias("y"),
        (F.col("id") % 4 + 1).cast("double").alias("w"))


def plain_boosting(rows, p):
    """The same trees by nested loops over thresholds, with sums of doubles."""
    soft = lambda g: np.sign(g) * max(abs(g) - p.l1, 0)
    worth = lambda g, h: soft(g) ** 2 / (h + p.l2)
    cuts = [sorted({r[1][f] for r in rows if r[1][f] is not None})[:-1] + [np.inf] for f in range(len(rows[0][1]))]
    margins = {k: 0.0 for k, *_ in rows}
    splits = []

    def grow(part, depth, grads, tree, node):
        g, h = (sum(grads[k][i] for k, *_ in part) for i in (0, 1))
        best = (max(p.gamma, 1e-6) - 1e-9, None)
        for f, at in enumerate(cuts if depth < p.depth else []):
            for cut in at:
                for missing_right in (True, False):
                    left = [r for r in part if (not missing_right if r[1][f] is None else r[1][f] <= cut)]
                    lg, lh = (sum(grads[k][i] for k, *_ in left) for i in (0, 1))
                    if min(lh, h - lh) < p.least_hessian:
                        continue
                    gain = worth(lg, lh) + worth(g - lg, h - lh) - worth(g, h)
                    if gain > best[0] + 1e-7:
                        best = gain, (f, cut, missing_right, left)
        if best[1] is None:
            for k, *_ in part:
                margins[k] += -p.rate * soft(g) / (h + p.l2)
            return
        f, cut, missing_right, left = best[1]
        splits.append((tree, node, f, cut, missing_right))
        chosen = {r[0] for r in left}
        grow(left, depth + 1, grads, tree, 2 * node)
        grow([r for r in part if r[0] not in chosen], depth + 1, grads, tree, 2 * node + 1)

    for tree in range(p.rounds):
        grads = {}
        for k, _, y, w in rows:
            chance = 1 / (1 + np.exp(-margins[k]))
            grads[k] = (w * (chance - y), w * chance * (1 - chance))
        grow(rows, 0, grads, tree, 1)
    return splits, {k: 1 / (1 + np.exp(-m)) for k, m in margins.items()}


def test_three_rounds_against_plain_code(spark):
    df = patients(spark)
    model = fit_boosted(df, ["a", "b", "c"], "y", "id", "w", SMALL)
    got = df.orderBy("id").collect()
    known = lambda x: None if x is None or np.isnan(x) else float(x)
    splits, chances = plain_boosting([(r["id"], [known(r[c]) for c in "abc"], r["y"], r["w"]) for r in got], SMALL)
    found = [(n["tree"], n["node"], n["feature"], n["threshold"], n["missing_right"]) for n in model.nodes if n["feature"] is not None]
    assert sorted(found) == sorted(splits) and len({n[0] for n in splits}) == 3 and any(not n[4] for n in splits)
    scored = {r["id"]: r for r in score_boosted(model, df, "id").collect()}
    assert len(scored) == 500
    assert max(abs(scored[k]["risk_probability"] - p) for k, p in chances.items()) < 1e-6
    assert np.mean([scored[r["id"]]["prediction"] == r["y"] for r in got]) > 0.8


def test_one_model_on_any_partitions(spark, monkeypatch):
    monkeypatch.setattr(boosting, "KEEP", 2)
    df = patients(spark)
    p = BoostingParams(rounds=5, depth=3, rows=0.7, columns=0.7, gamma=0.1, seed=9)
    one = fit_boosted(df, ["a", "b", "c"], "y", "id", "w", p)
    assert one == fit_boosted(df.repartition(5), ["a", "b", "c"], "y", "id", "w", p, partitions=3)
    assert len(one.nodes) > 15 and len({n["hessian"] for n in one.nodes if n["node"] == 1}) == 5
    assert one != fit_boosted(df, ["a", "b", "c"], "y", "id", "w", BoostingParams(**{**one.params.__dict__, "seed": 8}))
    assert BoostedTrees.from_json(one.to_json()) == one


def test_penalties(spark):
    df = patients(spark)
    leaves = lambda p: [n for n in fit_boosted(df, ["a", "b"], "y", "id", None, p).nodes if n["feature"] is None]
    free = BoostingParams(rounds=2, depth=4, gamma=0.0, l1=0.0, l2=0.0, rows=1.0, columns=1.0)
    assert len(leaves(free)) > len(leaves(BoostingParams(**{**free.__dict__, "gamma": 20.0})))
    assert [n["step"] for n in leaves(BoostingParams(**{**free.__dict__, "l1": 1e6}))] == [0.0, 0.0]
    most = lambda p: max(abs(n["step"]) for n in leaves(p))
    assert most(free) > most(BoostingParams(**{**free.__dict__, "l2": 50.0}))
    heavy = leaves(BoostingParams(**{**free.__dict__, "least_hessian": 20.0}))
    assert min(n["hessian"] for n in heavy) >= 20


def test_missing_values_apart(spark):
    """Where only being missing tells the classes apart, the split parts known from missing."""
    df = spark.range(200).select("id", F.when(F.col("id") % 4 != 0, F.col("id") % 3).alias("a"), (F.col("id") % 4 == 0).cast("int").alias("y"))
    model = fit_boosted(df, ["a"], "y", "id", None, SMALL)
    assert model.nodes[0]["threshold"] == np.inf and model.nodes[0]["missing_right"]
    for scored in (score_boosted(model, df, "id"), compile_boosted(model).score(df, "id")):
        assert all(r["prediction"] == (r["id"] % 4 == 0) for r in scored.collect())
    assert BoostedTrees.from_json(model.to_json()) == model


def test_edges(spark):
    df = patients(spark)
    none = fit_boosted(df.limit(0), ["a", "b"], "y", "id", "w", SMALL)
    assert none.nodes == () and {r["risk_probability"] for r in score_boosted(none, df, "id").collect()} == {0.5}
    flat = df.select("id", F.lit(1.0).alias("a"), F.lit(None).cast("double").alias("b"), "y", "w")
    model = fit_boosted(flat, ["a", "b"], "y", "id", "w", SMALL)
    assert all(n["feature"] is None for n in model.nodes) and score_boosted(model, flat, "id").count() == 500
    odd = df.withColumn("y", F.when(F.col("id") % 2 == 0, F.col("y"))).withColumn("w", F.when(F.col("id") % 3 != 0, F.col("w")))
    same = odd.where("y is not null and w is not null")
    assert fit_boosted(odd, ["a"], "y", "id", "w", SMALL) == fit_boosted(same, ["a"], "y", "id", "w", SMALL)
    with pytest.raises(ValueError):
        BoostingParams(depth=0)
    assert quantile_cuts(df, ["a", "b"], 16)[0] == [float(i) for i in range(10)]


def test_expressions_score_alike(spark):
    df = patients(spark)
    model = fit_boosted(df, ["a", "b", "c"], "y", "id", "w", SMALL)
    batch, plain = (d.orderBy("id").collect() for d in (score_boosted(model, df, "id"), compile_boosted(model).score(df, "id")))
    assert [r["prediction"] for r in batch] == [r["prediction"] for r in plain]
    assert max(abs(a["risk_probability"] - b["risk_probability"]) for a, b in zip(batch, plain, strict=True)) < 1e-12


def test_cells_rows_and_one_partition_alike(spark, monkeypatch):
    df = patients(spark).withColumn("w", F.col("w") * 1e5)
    p = BoostingParams(rounds=12, depth=3, rows=0.7, columns=0.7, gamma=0.1, seed=9)
    fit = lambda **more: fit_boosted(df, ["a", "b", "c"], "y", "id", "w", p, **more)
    one = fit()
    spark.sparkContext.setJobGroup("cells", "boosting over cells")
    assert fit(partitions=3) == one
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("cells")
    assert len(jobs) < 30  # not one for each of the 36 levels
    monkeypatch.setattr(boosting, "ROWS_EACH", 250)  # cells of many rows are dealt to several tasks
    assert fit(partitions=3) == one
    monkeypatch.setattr(boosting, "COUNTS", 0)
    assert fit(partitions=3) == one


def test_sums_beyond_exact_doubles():
    cell, x = np.array([0, 1, 0, 0]), np.array([2 ** 60 + 1, -5, 2 ** 53 + 1, -(2 ** 40) - 1])
    assert boosting._totals(cell, x, 2).tolist() == [2 ** 60 + 2 ** 53 - 2 ** 40 + 1, -5]
