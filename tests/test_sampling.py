import math
import statistics

import pytest
from pyspark.sql import functions as F

from riskframe.functions import normal, uniform
from riskframe.operators import sampling
from conftest import rows


def labelled(spark, n=4000):
    return spark.range(n).selectExpr("id", "int(id % 10 = 0) y", "double(id) v")


def test_draws_are_even_and_repeatable(spark):
    df = spark.range(4000)
    draws = [r[0] for r in rows(df.select(uniform(42, F.col("id"))))]
    assert min(draws) >= 0 and max(draws) < 1 and statistics.mean(draws) == pytest.approx(0.5, abs=0.02)
    assert draws != [r[0] for r in rows(df.select(uniform(43, F.col("id"))))]
    normals = [r[0] for r in rows(df.select(normal(42, F.col("id"), "v")))]
    assert statistics.mean(normals) == pytest.approx(0, abs=0.06)
    assert statistics.stdev(normals) == pytest.approx(1, abs=0.06)
    assert rows(df.limit(1).select(uniform(42, F.lit(None).cast("long")))) == [(None,)]


@pytest.mark.parametrize("parts", [1, 17])
def test_operators_do_not_depend_on_partitioning(spark, parts):
    df = labelled(spark, 500)
    moved = df.repartition(parts)

    def everything(d):
        train, _ = sampling.stratified_split(d, "y", "id")
        exact, _ = sampling.stratified_split(d, "y", "id", exact=True)
        noisy = sampling.add_noise(d, ["v"], "id")
        return (sorted(rows(train)), sorted(rows(exact)), sorted(rows(noisy)),
                rows(sampling.shuffle_rows(d, "id")))
    assert everything(df) == everything(moved)


def test_split_is_proportional(spark):
    train, test = sampling.stratified_split(labelled(spark), "y", "id", 0.2)
    got = {r["y"]: (r["n_train"], r["n_test"]) for r in sampling.coverage(train, test, "y").collect()}
    for n_train, n_test in got.values():
        assert n_test / (n_train + n_test) == pytest.approx(0.2, abs=0.05)
    assert sum(sum(v) for v in got.values()) == 4000


@pytest.mark.parametrize("fetch", [10_000, 30])
def test_exact_split_counts_and_membership(spark, monkeypatch, fetch):
    monkeypatch.setattr(sampling, "FETCH_ROWS", fetch)
    df = labelled(spark)
    _, test = sampling.stratified_split(df, "y", "id", 0.25, exact=True)
    draws = rows(df.select("y", uniform(42, F.col("id")).alias("u"), "id"))
    for y, want in ((0, 900), (1, 100)):
        smallest = sorted((u, i) for c, u, i in draws if c == y)[:want]
        assert sorted(r["id"] for r in test.filter(F.col("y") == y).collect()) == sorted(i for _, i in smallest)


def test_equal_draws_are_decided_by_key(spark, monkeypatch):
    monkeypatch.setattr(sampling, "FETCH_ROWS", 3)
    df = spark.range(6).selectExpr("id", "1 y")
    draw = F.when(F.col("id") < 2, 0.25).otherwise(0.5).cast("double")
    chosen = sampling.smallest_draws(df, "y", "id", draw, {1: 4}, {1: 6})
    assert [r[0] for r in rows(df.filter(chosen).orderBy("id"))] == [0, 1, 2, 3]


def test_coverage_guard(spark):
    df = labelled(spark, 50)
    with pytest.raises(ValueError, match="missing from one side"):
        sampling.check_coverage(df, df.filter("y = 0"), "y")
    sampling.check_coverage(df, df, "y")


def test_shuffle_is_a_permutation_in_draw_order(spark):
    df = labelled(spark, 300)
    got = [r["id"] for r in sampling.shuffle_rows(df, "id").collect()]
    draws = {r[0]: r[1] for r in rows(df.select("id", uniform(42, F.lit("order"), F.col("id"))))}
    assert got == sorted(range(300), key=lambda i: draws[i]) and got != list(range(300))
    other = [r["id"] for r in sampling.shuffle_rows(df, "id", partitions=13).collect()]
    assert other == got


def test_replicate_append_random_split(spark):
    df = labelled(spark, 20)
    assert sampling.replicate(df, 3).groupBy("copy").count().count() == 3
    out = sampling.append_rows(df, df.select("v"))
    assert out.count() == 40 and out.filter("id is null").count() == 20
    train, test = sampling.random_split(df)
    assert train.count() + test.count() == 20


def test_noise_has_the_given_spread(spark):
    df = labelled(spark, 3000)
    noise = [r[0] for r in rows(sampling.add_noise(df, ["v"], "id", sd=0.5)
                                .select(F.col("v") - F.col("id")))]
    assert statistics.stdev(noise) == pytest.approx(0.5, abs=0.03) and not any(map(math.isnan, noise))


def test_exact_split_wants_keys(spark):
    df = spark.createDataFrame([(None, 1)] * 5 + [(1, 0), (2, 1)], "id long, y int")
    with pytest.raises(ValueError, match="nulls"):
        sampling.test_side(df, "y", "id", 0.2, exact=True)
