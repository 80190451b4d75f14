"""Projections, filters and label handling."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import is_fractional, numeric_columns

# Accepted names of the label column, in order of preference.
TARGET_NAMES = ("target", "num", "label", "y", "Outcome")

# Most classes a label may have before it is taken for a mistake. The class
# tables brought to the driver or written into a plan never exceed this.
MAX_CLASSES = 1000


def _replace(df: DataFrame, exprs: dict) -> DataFrame:
    """One projection with some columns replaced, order kept, new ones appended."""
    kept = [exprs[c].alias(c) if c in exprs else F.col(f"`{c}`") for c in df.columns]
    added = [e.alias(c) for c, e in exprs.items() if c not in df.columns]
    return df.select(*kept, *added)


def present(df: DataFrame, cols: Iterable[str]) -> list[str]:
    """Those of ``cols`` that ``df`` has, in the given order."""
    have = set(df.columns)
    return [c for c in dict.fromkeys(cols) if c in have]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into null in every float and double column."""
    floats = [c for c in df.columns if is_fractional(df, c)]
    return _replace(df, {c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def normalize_categoricals(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Text form of each column, blanks trimmed, lower case. Null stays null."""
    return _replace(df, {c: F.lower(F.trim(F.col(c).cast("string"))) for c in present(df, cols)})


def drop_if_present(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.drop(*cols)


def binarize_label(df: DataFrame, label: str, null_label: str = "zero") -> DataFrame:
    """Label 1 where positive, else 0, as int.

    A null label becomes 0 with ``null_label="zero"``, the usual meaning here.
    With ``"keep"`` it stays null, with ``"drop"`` its row is removed.
    """
    if null_label not in ("zero", "keep", "drop"):
        raise ValueError(f"null_label must be zero, keep or drop, not {null_label!r}")
    flag = F.when(F.col(label) > 0, 1)
    if null_label == "zero":
        return _replace(df, {label: flag.otherwise(0).cast("int")})
    flag = flag.when(F.col(label).isNotNull(), 0).cast("int")
    df = df.filter(F.col(label).isNotNull()) if null_label == "drop" else df
    return _replace(df, {label: flag})


def cast_label(df: DataFrame, label: str, lenient: bool = False) -> DataFrame:
    """Label as int. ``lenient`` turns text that is no number into null."""
    c = F.col(label)
    return _replace(df, {label: c.try_cast("int") if lenient else c.cast("int")})


def zero_to_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Null in place of 0, for columns where zero means "not measured"."""
    return _replace(df, {c: F.when(F.col(c) != 0, F.col(c)) for c in present(df, cols)})


def select_numeric(df: DataFrame, label: str) -> DataFrame:
    """Numeric columns only, label last."""
    return df.select(*numeric_columns(df, exclude=[label]), label)


def find_target(df: DataFrame, candidates: Iterable[str] = TARGET_NAMES) -> str:
    """Name of the first candidate the table has."""
    candidates = list(candidates)
    found = present(df, candidates)
    if not found:
        raise ValueError(f"no target column among {candidates}; the table has {df.columns}")
    return found[0]


def detect_target(df: DataFrame, candidates: Iterable[str] = TARGET_NAMES,
                  to: str = "label") -> DataFrame:
    """Rename the first candidate the table has to ``to``."""
    name = find_target(df, candidates)
    if name != to and to in df.columns:
        raise ValueError(f"the table has both {name} and {to}; rename one of them first")
    return df.withColumnRenamed(name, to)


def split_feature_columns(df: DataFrame, label: str, categorical: Iterable[str] = (),
                          exclude: Iterable[str] = ()) -> tuple[list[str], list[str]]:
    """Names of the numeric and of the categorical features."""
    cats = list(categorical)
    skip = {label, "_class_weight", *cats, *exclude}
    return numeric_columns(df, exclude=skip), present(df, cats)


def booleans_to_int(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Boolean columns as 1 and 0, nulls kept, so that they count as numeric features."""
    skip = set(exclude)
    flags = [f.name for f in df.schema if f.dataType.typeName() == "boolean" and f.name not in skip]
    return df.withColumns({c: F.col(f"`{c}`").cast("int") for c in flags})


def feature_frame(df: DataFrame, label: str, categorical: Iterable[str] = (),
                  key: str | None = None, booleans_as_int: bool = False) -> DataFrame:
    """Key, label, numeric features, categorical features, in this order.

    Boolean columns are features only with ``booleans_as_int``, as 1 and 0.
    """
    keys, categorical = [key] if key else [], list(categorical)
    if booleans_as_int:
        df = booleans_to_int(df, exclude=[label, *categorical, *keys])
    numeric, cats = split_feature_columns(df, label, categorical, exclude=keys)
    return df.select(*keys, label, *numeric, *cats)


def filter_class(df: DataFrame, label: str, value) -> DataFrame:
    return df.filter(F.col(label) == F.lit(value))


def head_sample(df: DataFrame, n: int = 10, key: str | None = None) -> DataFrame:
    """First ``n`` rows, by ``key`` when given so that the answer is stable."""
    return (df.orderBy(key) if key else df).limit(n)


def classes_of(df: DataFrame, label: str) -> DataFrame:
    return df.select(label).distinct()


def class_counts(df: DataFrame, label: str, max_classes: int = MAX_CLASSES) -> dict:
    """Rows per class as a dict; refuses a label with too many values."""
    rows = df.groupBy(label).count().limit(max_classes + 1).collect()
    if len(rows) > max_classes:
        raise ValueError(f"{label} has more than {max_classes} values; it is no class label")
    return {r[0]: r[1] for r in sorted(rows, key=lambda r: (r[0] is not None, r[0]))}
