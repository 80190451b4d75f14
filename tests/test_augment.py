import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import augment, neighbors
from riskframe.operators.neighbors import build_index, knn
from riskframe.plans import augment_table
from conftest import rows


def cloud(spark, n=300, copies=100, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)).round(1)
    x[:copies] = x[0]
    data = [(int(i), 1 if i < n // 3 else 0, *map(float, r)) for i, r in enumerate(x)]
    return spark.createDataFrame(data, "id long, y int, a double, b double, c double").repartition(4), x


def brute_neighbours(x, k):
    out = {}
    for i in range(len(x)):
        dist = ((x - x[i]) ** 2).sum(1)
        out[i] = [j for j in np.argsort(dist, kind="stable") if j != i][:k]
    return out


@pytest.mark.parametrize("chunk", [16_384, 9])
def test_self_neighbours_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(neighbors, "CHUNK_ROWS", chunk)
    df, x = cloud(spark)
    index = build_index(df, "id", ["a", "b", "c"], 6, cell_rows=16)
    assert len(index.boxes["n"]) > 4
    got = {}
    for r in knn(index, df, "id", ["a", "b", "c"], drop_self=True).collect():
        got.setdefault(r["query_key"], {})[r["rank"]] = r["donor_key"]
    want = brute_neighbours(x, 5)
    assert {i: [v[r] for r in range(1, 6)] for i, v in got.items()} == want


@pytest.mark.parametrize("chunk, most", [(16_384, 1), (16_384, 8), (30, 2)])
def test_inner_cells_keep_the_answers(spark, monkeypatch, chunk, most):
    """However few the outer cells, the inner ones are as small as asked for."""
    monkeypatch.setattr(neighbors, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(neighbors, "MAX_CELLS", most)
    monkeypatch.setattr(neighbors, "INNER_SAMPLE", 64)
    df, x = cloud(spark)
    index = build_index(df, "id", ["a", "b", "c"], 6, cell_rows=8)
    sizes = [r["n"] for r in index.inner.collect()]
    assert len(index.boxes["n"]) <= most and len(sizes) > 2 * len(index.boxes["n"]) and max(sizes) < 32
    got = {}
    for r in knn(index, df, "id", ["a", "b", "c"], drop_self=True).collect():
        got.setdefault(r["query_key"], {})[r["rank"]] = r["donor_key"]
    assert {i: [v[r] for r in range(1, 6)] for i, v in got.items()} == brute_neighbours(x, 5)


def test_balance_reaches_equality_between_neighbours(spark):
    df, x = cloud(spark, copies=1)
    made = augment.smote_balance(df, "id", ["a", "b", "c"], "y")
    got = made.collect()
    assert len(got) == 100 and {r["y"] for r in got} == {1}
    near = brute_neighbours(x[:100], 5)
    for r in got:
        base = int(r["key"].split("#")[0])
        point = np.array([r["a"], r["b"], r["c"]])
        gaps = []
        for j in near[base]:
            step = x[j] - x[base]
            share = np.dot(point - x[base], step) / max(np.dot(step, step), 1e-12)
            gaps.append(np.abs(x[base] + np.clip(share, 0, 1) * step - point).max())
        assert min(gaps) < 1e-9
    moved = augment.smote_balance(df.repartition(1), "id", ["a", "b", "c"], "y")
    assert sorted(rows(moved)) == sorted(map(tuple, got))


def test_balance_spreads_rows_evenly(spark):
    df = spark.createDataFrame([(i, int(i < 3), float(i)) for i in range(14)], "id long, y int, a double")
    per_base = {}
    for r in augment.smote_balance(df, "id", ["a"], "y").collect():
        base = r["key"].split("#")[0]
        per_base[base] = per_base.get(base, 0) + 1
    assert sorted(per_base.values()) == [2, 3, 3]        # 8 rows needed


def test_minority_of_one_or_none_gives_nothing(spark):
    one = spark.createDataFrame([(1, 1, 0.0), (2, 0, 1.0), (3, 0, 2.0)], "id long, y int, a double")
    assert augment.smote_balance(one, "id", ["a"], "y").count() == 0
    assert augment.smote_bucketed(one, "id", ["a"], "y").count() == 0
    even = spark.createDataFrame([(1, 1, 0.0), (2, 0, 1.0)], "id long, y int, a double")
    assert augment.smote_balance(even, "id", ["a"], "y").count() == 0
    assert augment.minority_class({0: 2, 1: 2}) == 0


def test_bucketed_counts_and_self(spark):
    df, _ = cloud(spark, copies=1)
    with_self = augment.smote_bucketed(df, "id", ["a", "b", "c"], "y", k=3, bucket_size=1000)
    assert with_self.count() == 300
    # the first neighbour is the row itself, so slot 1 repeats it
    base = {r["id"]: (r["a"], r["b"], r["c"]) for r in df.collect()}
    for r in with_self.filter("key like '%#1'").collect():
        assert (r["a"], r["b"], r["c"]) == pytest.approx(base[int(r["key"].split("#")[0])])
    assert sorted(rows(augment.smote_bucketed(df.repartition(1), "id", ["a", "b", "c"], "y"))) == \
        sorted(rows(augment.smote_bucketed(df.repartition(9), "id", ["a", "b", "c"], "y")))
    with pytest.raises(ValueError):
        augment.smote_bucketed(df, "id", ["a"], "y", scope="other")


def test_augment_table_without_key(spark):
    df = spark.createDataFrame([(float(i % 7), None if i == 3 else i, int(i % 4 == 0) * 2, "x") for i in range(40)],
                               "` a` double, b int, ` num` int, s string")
    out = augment_table(df, noise=0.0)
    assert out.columns == ["key", "num", "a", "b", "copy"]
    assert out.count() == 3 * (40 + 10 * 5)
    assert out.filter("b is null").count() == 0
    assert {r[0] for r in out.select("num").distinct().collect()} == {0, 1}


def test_many_slots_of_few_rows_are_spread(spark):
    """Two rare rows against many: their slots come from several partitions, and all come."""
    df = spark.range(20_002).select("id", F.when(F.col("id") < 2, 1).otherwise(0).alias("y"),
                                    F.col("id").cast("double").alias("a"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = augment.smote_balance(df, "id", ["a"], "y").persist()
        made.count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spread = made.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in spread) == 19_998 and len(spread) > 2
    assert made.select("key").distinct().count() == 19_998
