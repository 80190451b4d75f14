from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskframe.operators import dictionary
from riskframe.operators.dictionary import Dictionary, fit_dictionary
from riskframe.sources import scratch_path


def plain(values):
    counts = Counter(v for v in values if v is not None)
    return {v: i for i, (v, _) in enumerate(sorted(counts.items(), key=lambda c: (-c[1], c[0])))}


@pytest.mark.parametrize("heavy", [0, 2, 1000])
def test_numbers_by_frequency(spark, monkeypatch, heavy):
    monkeypatch.setattr(dictionary, "HEAVY", heavy)
    values = ["b"] * 50 + ["a"] * 7 + ["c"] * 7 + ["é", "Z", "", None, None] + ["long " * 500] * 9
    df = spark.createDataFrame(list(enumerate(values)), "id long, v string").withColumns({c: F.lit("x") for c in ("v_idx", "index", "value", "n")})
    learned = fit_dictionary(df, "v")
    want = plain(values)
    assert learned.size == len(want) == 7
    new = df.unionByName(df.limit(1).withColumn("v", F.lit("unseen")).withColumn("id", F.lit(-1).cast("long")))
    got = {r["id"]: r for r in learned.transform(new).collect()}
    assert len(got) == len(values) + 1 and got[-1]["v_idx"] == 7 and got[0]["value"] == "x"
    assert all(got[i]["v_idx"] == (want[v] if v is not None else 7) for i, v in enumerate(values))
    hot = {r["id"]: r["v_ohe"] for r in learned.one_hot(new).collect()}
    assert all((h["size"], h["indices"], h["values"]) == (8, [got[i]["v_idx"]], [1.0]) for i, h in hot.items())
    again = Dictionary.load(spark, learned.save(scratch_path(spark, "saved")), "v")
    assert sorted(map(tuple, again.transform(new).collect()), key=repr) == sorted(map(tuple, learned.transform(new).collect()), key=repr)


def test_numbers_and_nothing(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.lit(None).cast("string").alias("none"))
    assert fit_dictionary(df, "none").size == 0
    assert {r["none_idx"] for r in fit_dictionary(df, "none").transform(df).collect()} == {0}
    assert {(r["k"], r["k_idx"]) for r in fit_dictionary(df, "k").transform(df).collect()} == {(k, k) for k in range(7)}
    empty = fit_dictionary(df.limit(0), "k")
    assert empty.size == 0 and empty.transform(df.limit(0)).count() == 0


def test_a_million_values_and_a_hot_one(spark):
    n = 1_500_000
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 1_200_000)).alias("v"))
    learned = fit_dictionary(df, "v")
    values = 800_000                       # two thirds of the 1,200,000, and the hot one
    assert learned.size == values + 1
    entries = learned.entries
    assert entries.agg(F.min("index"), F.max("index"), F.count_distinct("index")).first()[:] == (0, values, values + 1)
    assert entries.where("index = 0").first()["value"] == "hot"
    coded = learned.transform(df)
    assert coded.count() == n and coded.where("v_idx = 0").count() == n // 3
    wrong = coded.join(entries.withColumnRenamed("value", "v"), "v").where("v_idx <> index").count()
    assert wrong == 0
    after = entries.select("index", "n", F.lead("n").over(dictionary_order()).alias("later")).where("later > n").count()
    assert after == 0


def dictionary_order():
    from pyspark.sql import Window
    return Window.partitionBy(F.floor(F.col("index") / 10_000)).orderBy("index")
