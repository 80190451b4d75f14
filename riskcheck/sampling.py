"""Queries: splits, synthetic rows, noise, copies, order."""

from __future__ import annotations

from pyspark.sql import functions as F

from pyspark.sql import Window

from riskcheck.registry import (RISK_EVENTS, query, risk_events, rounded, sql_normal, sql_uniform,
                                sql_vectors, vectors)
from riskframe.functions import uniform
from riskframe.operators import augment, sampling
from riskframe.operators.impute import MedianImputer
from riskframe.plans import augment_table

DRAW = sql_uniform(42, "event_id")


@query("s1_stratified_split", f"""WITH {RISK_EVENTS}
SELECT event_id, y, CASE WHEN {DRAW} < 0.2 THEN 'test' ELSE 'train' END AS side FROM risk""")
def _(spark, sf):
    df = risk_events(spark, sf).select("event_id", "y")
    train, test = sampling.stratified_split(df, "y", "event_id", 0.2)
    return train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test")))


@query("s2_exact_stratified_split", f"""WITH {RISK_EVENTS},
ranked AS (SELECT event_id, y, row_number() OVER (PARTITION BY y ORDER BY {DRAW}, event_id) AS rn,
  count(*) OVER (PARTITION BY y) AS n FROM risk)
SELECT event_id, y, CASE WHEN rn <= floor(0.2 * n + 0.5) THEN 'test' ELSE 'train' END AS side
FROM ranked""")
def _(spark, sf):
    df = risk_events(spark, sf).select("event_id", "y")
    test = sampling.test_side(df, "y", "event_id", 0.2, exact=True)
    return df.withColumn("side", F.when(test, "test").otherwise("train"))


@query("s3_random_split")
def _(spark, sf):
    train, test = sampling.random_split(risk_events(spark, sf).select("event_id", "y"), 0.2)
    return train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test")))


@query("s3_random_split_sides", """SELECT event_id, CAST(1 AS BIGINT) AS n_sides FROM events""")
def _(spark, sf):
    """Every event is on one side and on one only."""
    train, test = sampling.random_split(risk_events(spark, sf).select("event_id"), 0.2)
    return train.unionByName(test).groupBy("event_id").agg(F.count("*").alias("n_sides"))


@query("s4_coverage_guard", f"""WITH {RISK_EVENTS}
SELECT y, count(*) FILTER ({DRAW} >= 0.2) AS n_train, count(*) FILTER ({DRAW} < 0.2) AS n_test
FROM risk GROUP BY y""")
def _(spark, sf):
    train, test = sampling.stratified_split(risk_events(spark, sf), "y", "event_id", 0.2)
    return sampling.coverage(train, test, "y")


# every event, a missing k filled with the median first
COMPLETE = RISK_EVENTS + """,
base AS (SELECT event_id, y, value AS f0, coalesce(CAST(k AS DOUBLE),
  (SELECT quantile_cont(k, 0.5) FROM risk)) AS f1 FROM risk)"""


def complete_events(spark, sf):
    df = risk_events(spark, sf)
    df = MedianImputer(("k",), exact=True).fit(df).transform(df)
    return df.select("event_id", "y", F.col("value").alias("f0"), F.col("k").cast("double").alias("f1"))


def _mix(slot):
    return sql_uniform(42, "'mix'", "event_id", slot)


SMOTE_LOCAL = f"""minority AS (SELECT event_id, f0, f1, floor({sql_uniform(42, "'bucket'", 'event_id')}
    * ceil((SELECT count(*) FROM base WHERE y = 1) / 256.0)) AS bucket FROM base WHERE y = 1),
pairs AS (SELECT a.event_id, a.f0, a.f1, b.f0 AS n0, b.f1 AS n1, row_number() OVER (
    PARTITION BY a.event_id ORDER BY a.event_id <> b.event_id,
    (a.f0 - b.f0) * (a.f0 - b.f0) + (a.f1 - b.f1) * (a.f1 - b.f1), b.event_id) AS slot,
    count(*) OVER (PARTITION BY a.event_id) AS n
  FROM minority a JOIN minority b USING (bucket)),
synth AS (SELECT event_id || '#' || slot AS key, 1 AS y, f0 + {_mix('slot')} * (n0 - f0) AS f0,
    f1 + {_mix('slot')} * (n1 - f1) AS f1 FROM pairs WHERE slot <= least(5, n - 1))"""


@query("s5_smote_local", f"""WITH {COMPLETE}, {SMOTE_LOCAL}
SELECT key, y, round(f0, 6) + 0.0 AS f0, round(f1, 6) + 0.0 AS f1 FROM synth""")
def _(spark, sf):
    return rounded(augment.smote_bucketed(complete_events(spark, sf), "event_id", ["f0", "f1"], "y"))


VECTOR_DIST = " + ".join(f"(a.e{i} - b.e{i}) * (a.e{i} - b.e{i})" for i in range(64))


@query("s5_smote_per_bucket", f"""WITH {sql_vectors(64)},
dealt AS (SELECT *, floor({sql_uniform(42, "'bucket'", 'vec_id')}
    * ceil((SELECT count(*) FROM vecs) / 100.0)) AS bucket FROM vecs),
rarer AS (SELECT bucket, CASE WHEN count(*) FILTER (y = 1) < count(*) FILTER (y = 0) THEN 1 ELSE 0 END
    AS y FROM dealt GROUP BY bucket),
minority AS (SELECT * FROM dealt JOIN rarer USING (bucket, y)),
pairs AS (SELECT a.vec_id, a.y, {", ".join(f"a.e{i}, b.e{i} AS n{i}" for i in range(64))},
    row_number() OVER (PARTITION BY a.vec_id ORDER BY {VECTOR_DIST}, b.vec_id) AS slot,
    1 + count(*) OVER (PARTITION BY a.vec_id) AS n
  FROM minority a JOIN minority b ON a.bucket = b.bucket AND a.vec_id <> b.vec_id)
SELECT vec_id || '#' || slot AS key, y, {", ".join(
    f"round(e{i} + {sql_uniform(42, chr(39) + 'mix' + chr(39), 'vec_id', 'slot')} * (n{i} - e{i}), 6)"
    f" + 0.0 AS e{i}" for i in range(64))}
FROM pairs WHERE slot <= least(5, n - 1)""")
def _(spark, sf):
    return rounded(augment.smote_bucketed(vectors(spark, sf, 64), "vec_id", [f"e{i}" for i in range(64)],
                                          "y", bucket_size=100, scope="bucket", include_self=False))


SMOTE_BALANCE = f"""counts AS (SELECT count(*) FILTER (y = 1) AS n, count(*) FILTER (y = 0) AS other
  FROM base),
minority AS (SELECT event_id, f0, f1, row_number() OVER (
    ORDER BY {sql_uniform(42, "'extra'", 'event_id')}, event_id) AS pos FROM base WHERE y = 1),
near AS (SELECT a.event_id, b.f0 AS n0, b.f1 AS n1, row_number() OVER (PARTITION BY a.event_id
    ORDER BY (a.f0 - b.f0) * (a.f0 - b.f0) + (a.f1 - b.f1) * (a.f1 - b.f1), b.event_id) AS rn
  FROM minority a JOIN minority b ON a.event_id <> b.event_id),
wanted AS (SELECT event_id, f0, f1, unnest(range(1, 1 + CAST((other - n) // n
    + CASE WHEN pos <= (other - n) % n THEN 1 ELSE 0 END AS BIGINT))) AS slot FROM minority, counts),
picked AS (SELECT *, 1 + CAST(floor({sql_uniform(42, "'pick'", 'event_id', 'slot')} * 5) AS BIGINT) AS rn
  FROM wanted)
SELECT event_id || '#' || slot AS key, 1 AS y,
  round(f0 + {_mix('slot')} * (n0 - f0), 6) + 0.0 AS f0,
  round(f1 + {_mix('slot')} * (n1 - f1), 6) + 0.0 AS f1
FROM picked JOIN (SELECT * FROM near WHERE rn <= 5) USING (event_id, rn)"""


@query("s6_smote_balance", f"WITH {COMPLETE}, {SMOTE_BALANCE}")
def _(spark, sf):
    return rounded(augment.smote_balance(complete_events(spark, sf), "event_id", ["f0", "f1"], "y"))


@query("s7_gaussian_noise", f"""WITH {RISK_EVENTS}
SELECT event_id, round(value + 0.03 * {sql_normal(42, 'event_id', "'value'")}, 6) + 0.0 AS value,
  round(k + 0.03 * {sql_normal(42, 'event_id', "'k'")}, 6) + 0.0 AS k FROM risk""")
def _(spark, sf):
    df = risk_events(spark, sf).select("event_id", "value", "k")
    return rounded(sampling.add_noise(df, ["value", "k"], "event_id"))


@query("s8_replicate", """SELECT event_id, value, CAST(copy AS INTEGER) AS copy
FROM events, range(1, 4) t(copy)""")
def _(spark, sf):
    return sampling.replicate(risk_events(spark, sf).select("event_id", "value"), 3)


@query("s9_shuffle_rows", f"""WITH {RISK_EVENTS}
SELECT event_id, y, round({sql_uniform(42, "'order'", 'event_id')}, 9) AS place FROM risk
ORDER BY place""")
def _(spark, sf):
    df = risk_events(spark, sf).select("event_id", "y")
    shuffled = sampling.shuffle_rows(df, "event_id")
    return shuffled.withColumn("place", F.round(uniform(42, F.lit("order"), F.col("event_id")), 9))


@query("s9_shuffled_order", "SELECT event_id, TRUE AS in_order FROM events")
def _(spark, sf):
    """Each row stands in the partition of its draw, and behind a smaller draw."""
    df = risk_events(spark, sf).select("event_id")
    shuffled = sampling.shuffle_rows(df, "event_id", partitions=16).select(
        "event_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("pos"),
        uniform(42, F.lit("order"), F.col("event_id")).alias("draw"))
    before = F.lag("draw", 1, -1.0).over(Window.partitionBy("part").orderBy("pos"))
    return shuffled.select("event_id", ((F.col("draw") > before) & (
        F.floor(F.col("draw") * 16) == F.col("part"))).alias("in_order"))


@query("s10_append_rows", f"""WITH {RISK_EVENTS}
SELECT event_id, y, value FROM risk UNION ALL SELECT event_id, NULL, value * 2 FROM risk WHERE y = 1""")
def _(spark, sf):
    df = risk_events(spark, sf).select("event_id", "y", "value")
    extra = df.filter("y = 1").select((F.col("value") * 2).alias("value"), "event_id")
    return sampling.append_rows(df, extra)


def _noisy(c):
    return f"round({c} + 0.03 * {sql_normal(42, 'key', chr(39) + c + chr(39))}, 6) + 0.0 AS {c}"


@query("augment_table", f"""WITH {RISK_EVENTS},
base AS (SELECT event_id, y, value AS f0, coalesce(CAST(k AS DOUBLE),
    (SELECT quantile_cont(k, 0.5) FROM risk)) AS f1 FROM risk),
{SMOTE_LOCAL}, everything AS (SELECT CAST(event_id AS VARCHAR) AS key, y, f0, f1 FROM base
  UNION ALL SELECT key, y, f0, f1 FROM synth)
SELECT key, y, {_noisy('f0')}, {_noisy('f1')}, CAST(copy AS INTEGER) AS copy
FROM everything, range(1, 4) t(copy)""")
def _(spark, sf):
    df = risk_events(spark, sf).select("event_id", F.col("value").alias(" f0"),
                                       F.col("k").alias("f1 "), "event_type", "y")
    return rounded(augment_table(df, "event_id", exact=True))
