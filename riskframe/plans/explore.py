"""The explore view as one job: every profile of one prepared table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from riskframe.operators import profile
from riskframe.plans.prepare import Preparation, PreparedModel
from riskframe.sources.tables import stored
from riskframe.spec import DatasetSpec


@dataclass(frozen=True)
class Exploration:
    """Profiles of a prepared, stored table. The methods each plan one narrow pass over it."""

    spec: DatasetSpec
    prepared: PreparedModel
    table: DataFrame
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    engineered: tuple[str, ...]

    def overview(self) -> DataFrame:
        keyed = [self.spec.key] if self.spec.key else []
        return profile.overview(self.table, self.spec.label, self.categorical, exclude=keyed)

    def sample(self, n: int = 10) -> DataFrame:
        return self.table.limit(n)

    def describe(self, exact: bool = False) -> DataFrame:
        return profile.describe_numeric(self.table, self.numeric, exact=exact)

    def distribution(self, feature: str, bins: int = 30) -> DataFrame:
        """Rows per value of a category, rows per bin of a number."""
        if feature in self.categorical:
            return profile.value_counts(self.table, feature)
        if feature not in self.numeric:
            raise ValueError(f"{feature} is no feature; there are {[*self.numeric, *self.categorical]}")
        return profile.histogram(self.table, feature, bins)

    def correlation(self) -> DataFrame:
        """Of the given numeric columns and the label, without the engineered ones."""
        given = [c for c in self.numeric if c not in self.engineered]
        return profile.correlation(self.table, [*given, self.spec.label])

    def balance(self) -> DataFrame:
        return profile.class_balance(self.table, self.spec.label, self.spec.label_names)

    def breakdown(self, feature: str) -> DataFrame:
        """Rows per category and class."""
        return profile.crosstab(self.table, feature, self.spec.label)


def explore(df: DataFrame, spec: DatasetSpec, **options) -> Exploration:
    """Prepare ``df`` once, as for training, store it and give its profiles.

    ``options`` are those of ``Preparation``. Class weights are no features.
    """
    prepared = Preparation(spec, **options).fit(df)
    table = stored(prepared.transform(df), "explored")
    numeric, categorical = prepared.feature_columns(table)
    engineered = [c for c in numeric if c not in df.columns]
    return Exploration(spec, prepared, table, tuple(numeric), tuple(categorical), tuple(engineered))
