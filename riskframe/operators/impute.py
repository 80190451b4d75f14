"""Filling missing values. Each imputer learns in ``fit`` and fills in ``transform``.

``fit`` brings only learned constants to the driver (one aggregate for all
columns); ``transform`` is a projection with those constants as literals, so the
same values serve training rows, held-out rows and rows without a label.
NaN counts as missing throughout.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import known, numeric_columns, value_map
from riskframe.operators.clean import _replace, present
from riskframe.operators.neighbors import DonorIndex, build_index, knn
from riskframe.sources.tables import stored
from riskframe.operators.quantiles import OVERALL, quantiles


@dataclass(frozen=True)
class ClassMedianImputer:
    """Null cells get the median of the row's class.

    A class without any value uses the median of all rows, and 0.0 when there
    is none. Rows of a class outside ``classes`` keep their nulls.
    ``exact=False`` takes medians from a sketch with error 1/10000 of the rows.
    """

    cols: tuple[str, ...]
    label: str
    classes: tuple = (0, 1)
    exact: bool = False

    def fit(self, df: DataFrame) -> ClassMedianModel:
        cols = present(df, self.cols)
        if not cols:
            return ClassMedianModel({}, {}, self.label)
        found = quantiles(df, cols, [0.5], by=self.label, exact=self.exact)
        fallback = {c: found[OVERALL, c][0] if found[OVERALL, c][0] is not None else 0.0
                    for c in cols}
        medians = {}
        for c in cols:
            medians[c] = {}
            for k in self.classes:
                m = found.get((k, c), [None])[0]
                medians[c][k] = float(fallback[c] if m is None else m)
        return ClassMedianModel(medians, {c: float(v) for c, v in fallback.items()}, self.label)


@dataclass(frozen=True)
class ClassMedianModel:
    medians: Mapping[str, Mapping]
    overall: Mapping[str, float]
    label: str

    def transform(self, df: DataFrame, use_label: bool = True) -> DataFrame:
        """Fill nulls; ``use_label=False`` gives every row the overall median.

        Filling with the label is only sound on training rows: on a held-out
        row it writes the answer into the features. A table without the label
        column is always filled with the overall median.
        """
        by_class = use_label and self.label in df.columns
        exprs = {}
        for c in present(df, self.medians):
            fill = value_map(F.col(self.label), self.medians[c], F.lit(None)) if by_class \
                else F.lit(self.overall[c])
            exprs[c] = F.coalesce(known(df, c).cast("double"), fill)
        return _replace(df, exprs)


@dataclass(frozen=True)
class MeanImputer:
    """Null cells of numeric columns get the column mean, rounded half-even.

    ``cols=None`` takes every numeric column not in ``exclude``. Columns without
    any value stay null.
    """

    cols: tuple[str, ...] | None = None
    digits: int = 4
    exclude: tuple[str, ...] = ()

    def fit(self, df: DataFrame) -> ConstantModel:
        cols = numeric_columns(df, self.exclude) if self.cols is None else present(df, self.cols)
        if not cols:
            return ConstantModel({})
        row = df.agg(*(F.bround(F.avg(known(df, c).cast("double")), self.digits).alias(c)
                       for c in cols)).first()
        return ConstantModel({c: row[c] for c in cols if row[c] is not None})


@dataclass(frozen=True)
class ModeImputer:
    """Null cells get the most frequent value, the smallest one on a tie.

    With ``nulls_compete`` a column whose nulls outnumber every value is left
    as it is, so that its nulls reach the encoder's slot for unknowns.
    """

    cols: tuple[str, ...]
    nulls_compete: bool = False

    def fit(self, df: DataFrame) -> ConstantModel:
        cols = present(df, self.cols)
        if not cols:
            return ConstantModel({})
        texts = df.select(*(F.col(c).cast("string").alias(c) for c in cols))
        long = texts.unpivot([], cols, "name", "value")
        counted = long.groupBy("name", "value").count()
        if not self.nulls_compete:
            counted = counted.filter(F.col("value").isNotNull())
        rank = F.struct((-F.col("count")).alias("n"), F.col("value").isNotNull().alias("known"),
                        F.col("value").alias("v"))
        rows = counted.groupBy("name").agg(F.min_by("value", rank).alias("value")).collect()
        mode = {r["name"]: r["value"] for r in rows if r["value"] is not None}
        return ConstantModel({c: mode[c] for c in cols if c in mode})


@dataclass(frozen=True)
class MedianImputer:
    """Null cells get the column median; columns without any value are dropped."""

    cols: tuple[str, ...] | None = None
    exact: bool = False
    exclude: tuple[str, ...] = ()

    def fit(self, df: DataFrame) -> ConstantModel:
        cols = numeric_columns(df, self.exclude) if self.cols is None else present(df, self.cols)
        if not cols:
            return ConstantModel({})
        found = {c: v[0] for (_, c), v in quantiles(df, cols, [0.5], exact=self.exact).items()}
        return ConstantModel({c: float(found[c]) for c in cols if found[c] is not None},
                             tuple(c for c in cols if found[c] is None))


@dataclass(frozen=True)
class KnnImputer:
    """Null cells get the mean of the feature over the nearest rows that have it.

    Nearest by the coordinates both rows know (see ``operators.neighbors``), all
    fitted rows are possible donors. A row no donor can be compared with gets the
    mean of the fitted rows. Columns without any value are dropped.
    """

    cols: tuple[str, ...]
    key: str
    k: int = 5

    def fit(self, df: DataFrame) -> KnnModel:
        cols = present(df, self.cols)
        row = df.agg(*(F.avg(known(df, c).cast("double")).alias(c) for c in cols)).first()
        means = {c: row[c] for c in cols if row[c] is not None}
        return KnnModel(build_index(df, self.key, list(means), self.k), means, self.key,
                        tuple(c for c in cols if c not in means))


@dataclass(frozen=True)
class KnnModel:
    index: DonorIndex
    means: Mapping[str, float]
    key: str
    empty: tuple[str, ...] = ()

    def transform(self, df: DataFrame) -> DataFrame:
        cols = list(self.means)
        df = _replace(df, {c: known(df, c).cast("double") for c in cols})
        lacking = F.lit(False)
        for c in cols:
            lacking = lacking | F.col(c).isNull()
        # stored with a mark: every step below reads it, and a filter on many derived columns
        # would have the optimizer work out what it implies for each combination of them
        df = stored(df.withColumn("_lacking", lacking), "knn-rows")
        whole, gaps = df.filter(~F.col("_lacking")).drop("_lacking"), df.filter("_lacking").drop("_lacking")
        wanted = F.filter(F.array(*(F.when(F.col(c).isNull(), F.lit(i))
                                    for i, c in enumerate(cols))), lambda i: i.isNotNull())
        asked = gaps.select(self.key, *cols, wanted.alias("_targets"))
        near = knn(self.index, asked, self.key, cols, target="_targets")
        fills = near.groupBy(F.col("query_key").alias(self.key)).agg(
            *(F.avg(F.when(F.array_contains("targets", F.lit(i)), F.col(f"dx{i}"))).alias(f"_fill{i}")
              for i in range(len(cols))))
        # only incomplete rows take part in the join
        filled = gaps.join(fills, self.key, "left")
        exprs = {c: F.coalesce(F.col(c), F.col(f"_fill{i}"), F.lit(self.means[c]))
                 for i, c in enumerate(cols)}
        filled = _replace(filled, exprs).select(*whole.columns)
        return whole.unionByName(filled).drop(*self.empty)


@dataclass(frozen=True)
class ConstantModel:
    """One learned constant per column; ``empty`` columns are dropped."""

    values: Mapping[str, object]
    empty: tuple[str, ...] = ()

    def transform(self, df: DataFrame, keep_type: bool = False) -> DataFrame:
        """Fill nulls. A whole-number column filled with a fraction becomes
        double; ``keep_type`` keeps its type and cuts the fraction off."""
        exprs = {}
        for c in present(df, self.values):
            fill: Column = F.lit(self.values[c])
            if keep_type:
                fill = fill.cast(df.schema[c].dataType)
                exprs[c] = F.coalesce(known(df, c), fill)
            elif isinstance(self.values[c], float):
                exprs[c] = F.coalesce(known(df, c).cast("double"), fill)
            else:
                exprs[c] = F.coalesce(F.col(c), fill)
        return _replace(df, exprs).drop(*self.empty)


@dataclass(frozen=True)
class FieldRange:
    """Default of an input field with its range or its allowed options."""

    default: object
    low: float | None = None
    high: float | None = None
    options: tuple[str, ...] = field(default=())


# Ranges, defaults and options of the known input fields.
KNOWN_FIELDS: Mapping[str, FieldRange] = {
    "pregnancies": FieldRange(2, 0, 20),
    "glucose": FieldRange(120, 50, 300),
    "bloodpressure": FieldRange(72, 30, 140),
    "skinthickness": FieldRange(23, 0, 100),
    "insulin": FieldRange(80, 0, 900),
    "bmi": FieldRange(28.5, 10, 70),
    "diabetespedigreefunction": FieldRange(0.45, 0.0, 3.0),
    "age": FieldRange(35, 1, 120),
    "trestbps": FieldRange(130, 80, 200),
    "chol": FieldRange(246, 100, 600),
    "thalach": FieldRange(150, 60, 220),
    "oldpeak": FieldRange(1.0, 0.0, 10.0),
    "ca": FieldRange(0, 0, 3),
    "fbs": FieldRange(0, 0, 1),
    "sex": FieldRange("Male", options=("Male", "Female")),
    "cp": FieldRange("typical angina", options=("typical angina", "atypical angina",
                                                "non-anginal", "asymptomatic")),
    "restecg": FieldRange("normal", options=("normal", "stt abnormality", "lv hypertrophy")),
    "exang": FieldRange("FALSE", options=("TRUE", "FALSE")),
    "thal": FieldRange("normal", options=("normal", "fixed defect", "reversible defect")),
    "slope": FieldRange("upsloping", options=("upsloping", "flat", "downsloping")),
}
UNKNOWN_FIELD = FieldRange(0.0, 0.0, 1000.0)


def field_range(name: str, fields: Mapping[str, FieldRange] = KNOWN_FIELDS) -> FieldRange:
    """Range of a column, looked up by its name without case, blanks, underscores."""
    return fields.get(name.lower().replace(" ", "").replace("_", ""), UNKNOWN_FIELD)


def apply_defaults(df: DataFrame, cols: Iterable[str],
                   fields: Mapping[str, FieldRange] = KNOWN_FIELDS) -> DataFrame:
    """Fill nulls with the field defaults; options are compared in lower case,
    so a text default is filled in lower case too."""
    exprs = {}
    for c in present(df, cols):
        default = field_range(c, fields).default
        if isinstance(default, str):
            exprs[c] = F.coalesce(F.col(c), F.lit(default.lower()))
        elif isinstance(default, float):
            exprs[c] = F.coalesce(known(df, c).cast("double"), F.lit(default))
        else:
            exprs[c] = F.coalesce(known(df, c), F.lit(default))
    return _replace(df, exprs)


def range_report(df: DataFrame, cols: Iterable[str],
                 fields: Mapping[str, FieldRange] = KNOWN_FIELDS) -> DataFrame:
    """Per column: rows without a value, within and outside the field's range."""
    cols = present(df, cols)

    def inside(c):
        meta = field_range(c, fields)
        if meta.options:
            return F.lower(F.trim(F.col(c).cast("string"))).isin(
                [o.lower() for o in meta.options])
        return known(df, c).between(meta.low, meta.high)

    aggs = [F.struct(F.lit(c).alias("feature"),
                     F.count_if(known(df, c).isNull()).alias("n_missing"),
                     F.count_if(inside(c)).alias("n_inside"),
                     F.count_if(~inside(c)).alias("n_outside")) for c in cols]
    return df.agg(F.array(*aggs).alias("r")).select(F.inline("r"))
