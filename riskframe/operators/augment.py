"""Synthetic minority rows between neighbours.

The draws are keyed hashes, so the synthetic rows are the same on every run and
every partitioning. Synthetic rows get a text key made of the base row's key and
a slot number; features are double and must be filled first: a row with a missing
feature gives synthetic rows that lack it too.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.keyed_random import uniform
from riskframe.operators.clean import class_counts
from riskframe.operators.neighbors import build_index, knn
from riskframe.operators.sampling import smallest_draws

cloudpickle.register_pickle_by_value(__import__("sys").modules[__name__])


def minority_class(counts: Mapping) -> int:
    """The rarer of classes 0 and 1 by their row counts, class 0 on a tie."""
    return 1 if counts.get(1, 0) < counts.get(0, 0) else 0


def _synthetic(pairs: DataFrame, label: str, minority, cols: Sequence[str], seed: int,
               slot: str) -> DataFrame:
    """Rows at base + lambda * (neighbour - base), lambda drawn from key and slot.

    ``pairs`` has base_key, b0.., n0.., and the slot column.
    """
    share = uniform(seed, F.lit("mix"), F.col("base_key"), F.col(slot))
    made = [(F.col(f"b{i}") + share * (F.col(f"n{i}") - F.col(f"b{i}"))).alias(c)
            for i, c in enumerate(cols)]
    cls = F.col("minority") if minority is None else F.lit(minority)
    return pairs.select(F.concat_ws("#", F.col("base_key").cast("string"), F.col(slot))
                        .alias("key"), cls.cast("int").alias(label), *made)


def originals(df: DataFrame, key: str, cols: Sequence[str], label: str) -> DataFrame:
    """The given rows in the shape of the synthetic ones: key as text, label, features."""
    return df.select(F.col(key).cast("string").alias("key"), F.col(label).cast("int").alias(label),
                     *(F.col(c).cast("double").alias(c) for c in cols))


def smote_bucketed(df: DataFrame, key: str, cols: Sequence[str], label: str, k: int = 5,
                   bucket_size: int = 256, seed: int = 42, scope: str = "table",
                   include_self: bool = True) -> DataFrame:
    """Synthetic rows from neighbours within small random buckets.

    Rows are dealt to buckets of about ``bucket_size`` by a hash of their unique
    key, so no bucket grows with the data or with copies of a row. Each minority
    row of a bucket gives one synthetic row per neighbour among the bucket's
    minority rows: min(k, rows - 1) of them, the row itself counted as its first
    neighbour unless ``include_self=False``. A bucket with one minority row gives
    none.

    ``scope="table"``: the rarer class of the whole table, buckets of its rows
    only. ``scope="bucket"``: buckets of all rows, each with its own rarer class.

    Returns the synthetic rows: key, label, features.
    """
    if scope not in ("table", "bucket"):
        raise ValueError(f"scope must be table or bucket, not {scope!r}")
    counts = class_counts(df, label)
    minority = minority_class(counts) if scope == "table" else None
    rows = df if minority is None else df.filter(F.col(label) == minority)
    n_rows = sum(counts.values()) if minority is None else counts.get(minority, 0)
    n_buckets = max(1, math.ceil(n_rows / bucket_size))
    bucket = F.floor(uniform(seed, F.lit("bucket"), F.col(key)) * n_buckets)
    xs = [f"b{i}" for i in range(len(cols))]
    dealt = rows.select(bucket.alias("bucket"), F.col(key).alias("base_key"),
                        F.col(label).cast("int").alias("y"),
                        *(F.col(c).cast("double").alias(x) for c, x in zip(cols, xs)))
    key_type = dealt.schema["base_key"].dataType.simpleString()
    schema = f"base_key {key_type}, minority int, slot int, " + \
        ", ".join(f"b{i} double, n{i} double" for i in range(len(cols)))
    pairs = dealt.groupBy("bucket").applyInPandas(
        _bucket_pairs(len(cols), k, include_self, minority), schema)
    return _synthetic(pairs, label, minority, cols, seed, "slot")


def _bucket_pairs(dims: int, k: int, include_self: bool, minority):
    columns = ["base_key", "minority", "slot",
               *(c for i in range(dims) for c in (f"b{i}", f"n{i}"))]

    def pair(rows: pd.DataFrame) -> pd.DataFrame:
        rarer = minority
        if rarer is None:
            rarer = 1 if (rows["y"] == 1).sum() < (rows["y"] == 0).sum() else 0
        rows = rows[rows["y"] == rarer].sort_values("base_key", kind="stable")
        n = len(rows)
        take = min(k, n - 1)
        if take < 1:
            return pd.DataFrame({c: [] for c in columns})
        x = rows[[f"b{i}" for i in range(dims)]].to_numpy()
        dist = np.zeros((n, n))
        for i in range(dims):
            gap = x[:, i][:, None] - x[:, i][None, :]
            dist += gap * gap
        # the row itself first, or never; then by distance and key
        np.fill_diagonal(dist, -1.0 if include_self else np.inf)
        near = np.argsort(dist, axis=1, kind="stable")[:, :take]
        out = {"base_key": np.repeat(rows["base_key"].to_numpy(), take),
               "minority": rarer, "slot": np.tile(np.arange(1, take + 1), n)}
        for i in range(dims):
            out[f"b{i}"] = np.repeat(x[:, i], take)
            out[f"n{i}"] = x[near.ravel(), i]
        return pd.DataFrame(out)[columns]
    return pair


def smote_balance(df: DataFrame, key: str, cols: Sequence[str], label: str, k: int = 5,
                  seed: int = 42) -> DataFrame:
    """Synthetic rows that bring the minority up to the size of the other class.

    Neighbours are exact over the whole minority, the row itself excluded. The
    rows needed are spread evenly: each base row gives need // rows of them, and
    those with the smallest draws one more. Each synthetic row picks one of the k
    neighbours and a point between by keyed draws. A minority of one row gives
    none.
    """
    counts = class_counts(df, label)
    minority = minority_class(counts)
    n, other = counts.get(minority, 0), counts.get(1 - minority, 0)
    base = df.filter(F.col(label) == minority)
    k = min(k, n - 1)
    if k < 1 or other <= n:
        return originals(base, key, cols, label).limit(0)
    each, extra = divmod(other - n, n)
    draw = uniform(seed, F.lit("extra"), F.col(key))
    one_more = smallest_draws(base, label, key, draw, {minority: extra}, counts)
    dims = range(len(cols))
    near = knn(build_index(base, key, cols, k + 1), base, key, cols, drop_self=True)
    around = near.groupBy("query_key").agg(F.sort_array(F.collect_list(F.struct(
        "rank", *(F.col(f"dx{i}") for i in dims)))).alias("near"))     # k entries each
    rows = base.select(F.col(key).alias("base_key"), *(F.col(c).cast("double").alias(f"b{i}")
                       for i, c in enumerate(cols)),
                       (F.lit(each) + one_more.cast("int")).cast("bigint").alias("m"))
    rows = rows.filter(F.col("m") > 0).join(
        around.withColumnRenamed("query_key", "base_key"), "base_key")
    # two steps with a shuffle between, so that a row with very many slots is spread over
    # tasks and no array is longer than the root of their number
    step = math.isqrt(each) + 1
    runs = rows.withColumn("from", F.explode(F.sequence(F.lit(1), F.col("m"), F.lit(step)))) \
        .repartition("base_key", "from")
    slots = runs.withColumn("slot", F.explode(F.sequence(
        F.col("from"), F.least(F.col("m"), F.col("from") + step - 1)))).drop("from")
    pick = F.floor(uniform(seed, F.lit("pick"), F.col("base_key"), F.col("slot"))
                   * F.size("near")).cast("int")
    chosen = slots.withColumn("to", F.get("near", pick))
    pairs = chosen.select("base_key", "slot", *(f"b{i}" for i in dims),
                          *(F.col(f"to.dx{i}").alias(f"n{i}") for i in dims))
    return _synthetic(pairs, label, minority, cols, seed, "slot")
