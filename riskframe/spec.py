"""Description of a dataset: which columns play which role."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType


@dataclass(frozen=True)
class DatasetSpec:
    """Roles of the columns of one table.

    Columns named here but absent from a table are skipped by the operators;
    :meth:`missing_columns` reports them for callers who want to be strict.
    """

    label: str
    key: str | None = None
    label_names: Mapping[int, str] = field(
        default_factory=lambda: MappingProxyType({0: "Negative", 1: "Positive"}))
    binarize: bool = False
    drop: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    zero_as_missing: tuple[str, ...] = ()
    interactions: tuple[tuple[str, str], ...] = ()
    log_columns: tuple[str, ...] = ("Insulin", "insulin")
    params: Mapping[str, Mapping[str, object]] = field(default_factory=dict)

    def missing_columns(self, columns) -> list[str]:
        """Columns the spec names that ``columns`` lacks, in spec order."""
        named = [self.label, *([self.key] if self.key else []), *self.drop, *self.categorical,
                 *self.zero_as_missing, *(c for pair in self.interactions for c in pair)]
        present = set(columns)
        return [c for c in dict.fromkeys(named) if c not in present]

    def check(self, columns) -> None:
        """Raise when ``columns`` lacks something the spec names."""
        absent = self.missing_columns(columns)
        if absent:
            raise ValueError(f"columns named by the dataset spec are absent: {absent}")


# Column roles of the two known datasets, and tuned parameters where they
# differ from the defaults of plans.train.
HEART = DatasetSpec(
    label="num",
    label_names=MappingProxyType({0: "No Disease", 1: "Heart Disease"}),
    binarize=True,
    drop=("id", "origin"),
    categorical=("sex", "cp", "restecg", "exang", "thal", "slope"),
    interactions=(("trestbps", "chol"), ("thalach", "oldpeak"), ("age", "chol")),
)

DIABETES = DatasetSpec(
    label="Outcome",
    label_names=MappingProxyType({0: "Non-Diabetic", 1: "Diabetic"}),
    zero_as_missing=("Glucose", "BloodPressure", "SkinThickness", "Insulin", "BMI"),
    interactions=(("Glucose", "BMI"), ("BMI", "Age"), ("Glucose", "Insulin"),
                  ("Pregnancies", "Age")),
    params=MappingProxyType({
        "rf": {"numTrees": 300, "maxDepth": 10, "minInstancesPerNode": 2,
               "featureSubsetStrategy": "sqrt"},
        "gbt": {"maxIter": 100, "maxDepth": 5, "stepSize": 0.05, "subsamplingRate": 0.8,
                "minInstancesPerNode": 2},
        "lr": {"maxIter": 500, "regParam": 0.001, "elasticNetParam": 0.2},
    }),
)
