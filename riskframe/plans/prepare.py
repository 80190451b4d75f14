"""Clean, impute and engineer a table, learned once and applied alike everywhere."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from riskframe.operators.clean import (binarize_label, cast_label, drop_if_present, nan_to_null,
                                       normalize_categoricals, split_feature_columns, zero_to_null)
from riskframe.operators.features import (ClassWeightModel, ClassWeights, add_interactions,
                                          add_log1p)
from riskframe.operators.impute import (ClassMedianImputer, ClassMedianModel, ConstantModel,
                                        MeanImputer, ModeImputer)
from riskframe.spec import DatasetSpec


def clean(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """The label-independent row-wise steps, plus label handling if there is one."""
    df = normalize_categoricals(nan_to_null(df), spec.categorical)
    df = drop_if_present(df, spec.drop)
    if spec.label in df.columns:
        if spec.binarize:
            df = binarize_label(df, spec.label)
        df = cast_label(df, spec.label)
    return zero_to_null(df, spec.zero_as_missing)


@dataclass(frozen=True)
class Preparation:
    """``fit`` on training rows, ``transform`` any rows.

    ``class_medians=True`` fills zero-coded cells with the median of the row's
    own class wherever the label is known. Applied to held-out rows this leaks
    the label, so the default fills with the overall median. ``exact`` asks for
    exact medians, ``strict`` for an error when the table lacks a named column.
    """

    spec: DatasetSpec
    class_medians: bool = False
    exact: bool = False
    strict: bool = False

    def fit(self, df: DataFrame) -> PreparedModel:
        spec = self.spec
        if self.strict:
            spec.check(df.columns)
        base = clean(df, spec)
        medians = ClassMedianImputer(spec.zero_as_missing, spec.label, exact=self.exact).fit(base)
        filled = medians.transform(base, use_label=self.class_medians)
        keep_out = (spec.label, *spec.categorical, *([spec.key] if spec.key else []))
        means = MeanImputer(exclude=keep_out).fit(filled)
        modes = ModeImputer(spec.categorical).fit(base)
        weights = ClassWeights(spec.label).fit(base)
        return PreparedModel(spec, self.class_medians, medians, means, modes, weights)


@dataclass(frozen=True)
class PreparedModel:
    spec: DatasetSpec
    class_medians: bool
    medians: ClassMedianModel
    means: ConstantModel
    modes: ConstantModel
    weights: ClassWeightModel

    def transform(self, df: DataFrame) -> DataFrame:
        """Prepared rows. Works without a label column, then adds no weights."""
        df = self.medians.transform(clean(df, self.spec), use_label=self.class_medians)
        df = self.modes.transform(self.means.transform(df))
        df, _ = add_interactions(df, self.spec.interactions)
        df, _ = add_log1p(df, self.spec.log_columns)
        return self.weights.transform(df) if self.spec.label in df.columns else df

    def feature_columns(self, df: DataFrame) -> tuple[list[str], list[str]]:
        """Numeric and categorical features of a prepared table."""
        key = [self.spec.key] if self.spec.key else []
        return split_feature_columns(df, self.spec.label, self.spec.categorical, exclude=key)
