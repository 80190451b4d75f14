"""Small column helpers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns in schema order, without ``exclude``.

    Goes by the type, so byte and short count as numeric while arrays,
    intervals and booleans do not.
    """
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if f.name not in skip and isinstance(f.dataType, T.NumericType)]


def is_fractional(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def known(df: DataFrame, name: str) -> Column:
    """The column with NaN read as missing."""
    c = F.col(name)
    return F.when(~F.isnan(c), c) if is_fractional(df, name) else c


def value_map(key: Column, values: Mapping, default: Column) -> Column:
    """``values[key]``, ``default`` for other keys."""
    return reduce(lambda rest, k: F.when(key == F.lit(k), F.lit(values[k])).otherwise(rest),
                  values, default)
