"""Feature engineering and encoding."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import known, value_map
from riskframe.operators.clean import MAX_CLASSES, _replace, class_counts, present


def _double(name: str):
    return F.col(name).cast("double")


def add_interactions(df: DataFrame, pairs: Iterable[tuple[str, str]]) -> tuple[DataFrame, list[str]]:
    """``{a}_x_{b}`` = product of both, for the pairs the table has; and the names."""
    have = set(df.columns)
    exprs = {f"{a}_x_{b}": _double(a) * _double(b) for a, b in pairs if a in have and b in have}
    return _replace(df, exprs), list(exprs)


def add_log1p(df: DataFrame, cols: Iterable[str] = ("Insulin", "insulin")) \
        -> tuple[DataFrame, list[str]]:
    """``{c}_log`` = ln(c + 1), null at -1 and below; and the names."""
    exprs = {f"{c}_log": F.log1p(_double(c)) for c in present(df, cols)}
    return _replace(df, exprs), list(exprs)


def add_ratios(df: DataFrame, ratios: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``name: (a, b)`` adds a / b, null where b is 0."""
    return _replace(df, {n: F.try_divide(_double(a), _double(b)) for n, (a, b) in ratios.items()})


def add_powers(df: DataFrame, powers: Mapping[str, tuple[str, float]]) -> DataFrame:
    """``name: (c, p)`` adds c to the power p."""
    return _replace(df, {n: F.pow(_double(c), F.lit(float(p))) for n, (c, p) in powers.items()})


def add_flags(df: DataFrame, rules: Mapping[str, tuple[str, str, float]]) -> DataFrame:
    """``name: (c, ">" or "<", limit)`` adds 1 where it holds, else 0; missing is 0."""
    def flag(c, op, limit):
        value = known(df, c)
        if op not in (">", "<"):
            raise ValueError(f"flag operator must be > or <, not {op!r}")
        holds = value > limit if op == ">" else value < limit
        return F.coalesce(holds, F.lit(False)).cast("int")
    return _replace(df, {n: flag(*rule) for n, rule in rules.items()})


# Derived heart features with their limits.
HEART_RATIOS = {"chol_age_ratio": ("chol", "age"), "thalach_age_ratio": ("thalach", "age")}
HEART_POWERS = {"oldpeak_sq": ("oldpeak", 2)}
HEART_FLAGS = {"high_bp": ("trestbps", ">", 140), "high_chol": ("chol", ">", 240),
               "low_hr": ("thalach", "<", 120)}
HEART_PRODUCTS = {"age_oldpeak": ("age", "oldpeak"), "chol_oldpeak": ("chol", "oldpeak")}


def add_heart_features(df: DataFrame) -> DataFrame:
    """The ratio, square, threshold and product features of a heart table."""
    df = add_flags(add_powers(add_ratios(df, HEART_RATIOS), HEART_POWERS), HEART_FLAGS)
    return _replace(df, {n: _double(a) * _double(b) for n, (a, b) in HEART_PRODUCTS.items()})


@dataclass(frozen=True)
class ClassWeights:
    """``_class_weight`` = rows / (classes * rows of the class); 1.0 if unknown.

    Rows with a null label are counted in no class and weigh 1.0.
    """

    label: str
    column: str = "_class_weight"

    def fit(self, df: DataFrame) -> ClassWeightModel:
        counts = {k: n for k, n in class_counts(df, self.label).items() if k is not None}
        total = sum(counts.values())
        return ClassWeightModel({k: total / (len(counts) * n) for k, n in counts.items()},
                                self.label, self.column)


@dataclass(frozen=True)
class ClassWeightModel:
    weights: Mapping[object, float]
    label: str
    column: str

    def transform(self, df: DataFrame) -> DataFrame:
        weight = value_map(F.col(self.label), self.weights, F.lit(1.0))
        return _replace(df, {self.column: weight})


def check_cardinality(df: DataFrame, cols: Iterable[str], most: int = MAX_CLASSES) -> None:
    """Raise when a categorical has too many values to encode.

    Indexers keep the value list on the driver and encoders make one slot per
    value, so both need a bound on the number of values. Counted exactly, up to it.
    """
    wide = [c for c in cols if df.select(c).where(F.col(c).isNotNull()).distinct()
            .limit(most + 1).count() > most]
    if wide:
        raise ValueError(f"too many values to encode in {wide}, at most {most} each")


def indexer(*cols: str) -> StringIndexer:
    """Index by falling frequency, ties by value; unseen and null get the last index.
    All columns are counted in one pass."""
    return StringIndexer(inputCols=list(cols), outputCols=[f"{c}_idx" for c in cols],
                         handleInvalid="keep", stringOrderType="frequencyDesc")


def encoder(*cols: str) -> OneHotEncoder:
    """One slot per value plus one for unseen and null."""
    return OneHotEncoder(inputCols=[f"{c}_idx" for c in cols],
                         outputCols=[f"{c}_ohe" for c in cols], handleInvalid="keep")


def assembler(inputs: Iterable[str], output: str = "raw_features") -> VectorAssembler:
    """All features in one vector; rows with a missing feature are left out."""
    return VectorAssembler(inputCols=list(inputs), outputCol=output, handleInvalid="skip")


def string_index(df: DataFrame, col: str, most: int = MAX_CLASSES) -> DataFrame:
    check_cardinality(df, [col], most)
    return indexer(col).fit(df).transform(df)


def one_hot(df: DataFrame, col: str, most: int = MAX_CLASSES) -> DataFrame:
    indexed = string_index(df, col, most)
    return encoder(col).fit(indexed).transform(indexed)


def assemble(df: DataFrame, numeric: Iterable[str], encoded: Iterable[str] = ()) -> DataFrame:
    """``raw_features``: numeric columns, then encoded ones; incomplete rows left out."""
    return assembler([*numeric, *encoded]).transform(df)


def incomplete_rows(df: DataFrame, numeric: Iterable[str]) -> DataFrame:
    """How many rows :func:`assemble` keeps and leaves out."""
    whole = F.lit(True)
    for c in numeric:
        whole = whole & known(df, c).isNotNull()
    return df.agg(F.count_if(whole).alias("n_kept"), F.count_if(~whole).alias("n_skipped"))


@dataclass(frozen=True)
class Standardizer:
    """``{c}_std`` = (c - mean) / deviation per column; a constant column becomes 0.

    ``ddof=1`` divides by the sample deviation as Spark's scaler does,
    ``ddof=0`` by the population deviation.
    """

    cols: tuple[str, ...]
    ddof: int = 1
    suffix: str = "_std"

    def fit(self, df: DataFrame) -> StandardizerModel:
        cols = present(df, self.cols)
        spread = F.stddev_samp if self.ddof else F.stddev_pop
        aggs = []
        for i, c in enumerate(cols):
            value = known(df, c).cast("double")
            aggs += [F.avg(value).alias(f"m{i}"), spread(value).alias(f"s{i}")]
        row = df.agg(*aggs).first() if cols else None
        return StandardizerModel({c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)},
                                 self.suffix)


@dataclass(frozen=True)
class StandardizerModel:
    moments: Mapping[str, tuple[float, float]]
    suffix: str

    def transform(self, df: DataFrame) -> DataFrame:
        exprs = {}
        for c in present(df, self.moments):
            mean, spread = self.moments[c]
            centred = known(df, c).cast("double") - F.lit(mean)
            exprs[c + self.suffix] = centred / F.lit(spread) if spread else centred * 0.0
        return _replace(df, exprs)
