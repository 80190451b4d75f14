"""Enlarge a table: synthetic minority rows, noise, copies, random order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import numeric_columns
from riskframe.operators.augment import originals, smote_bucketed
from riskframe.operators.clean import (TARGET_NAMES, binarize_label, find_target, nan_to_null)
from riskframe.operators.impute import MedianImputer
from riskframe.operators.sampling import (add_noise, append_rows, replicate, shuffle_rows)
from riskframe.sources.tables import stored, trim_headers


def with_row_key(df: DataFrame, name: str = "row_key") -> DataFrame:
    """Number the rows of a table without a key and store the result, so that
    the numbers stay the same whenever it is read again."""
    return stored(df.withColumn(name, F.monotonically_increasing_id()), "keyed")


def augment_table(df: DataFrame, key: str | None = None, k: int = 5, bucket_size: int = 256,
                  noise: float = 0.03, copies: int = 3, seed: int = 42, exact: bool = False,
                  scope: str = "table", targets=TARGET_NAMES) -> DataFrame:
    """Binarised label and median-filled numeric features, with synthetic rows of
    the rarer class, N(0, noise) on every cell, each row ``copies`` times, in
    random order.

    Result: key (text), copy, label, features.
    """
    df = trim_headers(df)
    label = find_target(df, targets)
    if key is None:
        df, key = with_row_key(df), "row_key"
    df = binarize_label(nan_to_null(df), label)
    numeric = numeric_columns(df, exclude=[label, key])
    features = MedianImputer(tuple(numeric), exact=exact).fit(df)
    df = features.transform(df.select(key, *numeric, label))
    cols = [c for c in numeric if c in df.columns]
    rows = append_rows(originals(df, key, cols, label),
                       smote_bucketed(df, key, cols, label, k, bucket_size, seed, scope))
    rows = replicate(add_noise(rows, cols, "key", noise, seed), copies)
    order = F.concat_ws("#", "key", "copy")
    return shuffle_rows(rows.withColumn("_order", order), "_order", seed).drop("_order")
