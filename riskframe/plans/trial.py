"""The trial chain as one job: features, split, neighbour fill, scaling, balance, boosting, report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.augment import originals, smote_balance
from riskframe.operators.boosting import BoostedTrees, BoostingParams, fit_boosted, score_boosted
from riskframe.operators.clean import binarize_label, feature_frame, split_feature_columns
from riskframe.operators.evaluate import classification_report
from riskframe.operators.features import Standardizer, StandardizerModel, add_heart_features
from riskframe.operators.impute import KnnImputer, KnnModel
from riskframe.operators.sampling import append_rows, check_coverage, stratified_split
from riskframe.plans.train import SLOW_BOOSTING
from riskframe.sources.tables import stored


@dataclass(frozen=True)
class Trial:
    """What a trial learned and found. ``features`` are the scaled columns in model order;
    ``training`` holds key (as text), label and features of the balanced training rows,
    ``predictions`` key, label, prediction, risk_probability and risk_band of the test rows."""

    derive: Callable[[DataFrame], DataFrame]
    imputer: KnnModel
    scaler: StandardizerModel
    features: tuple[str, ...]
    model: BoostedTrees
    training: DataFrame
    predictions: DataFrame
    report: DataFrame

    def score(self, df: DataFrame, key: str) -> DataFrame:
        """Scores of new rows that have the trial's input columns, a label or not."""
        filled = self.imputer.transform(_numbers(self.derive(df)))
        return score_boosted(self.model, self.scaler.transform(filled), key)


def _numbers(df: DataFrame) -> DataFrame:
    flags = [f.name for f in df.schema if f.dataType.typeName() == "boolean"]
    return df.withColumns({c: F.col(f"`{c}`").cast("int") for c in flags})


def run_trial(df: DataFrame, key: str, label: str,
              derive: Callable[[DataFrame], DataFrame] = add_heart_features, k: int = 5,
              test_frac: float = 0.2, seed: int = 42, params: BoostingParams = SLOW_BOOSTING) -> Trial:
    """Run the whole chain on a table with a unique key.

    The label becomes 1 where positive, null as 0. Fill, scale and balance are learned
    from the training rows of an exact stratified split and only applied to the test
    rows; synthetic rows are in the training table alone. Features are the numeric and
    boolean columns and what ``derive`` adds; columns without any value are left out.
    """
    rows = feature_frame(binarize_label(derive(df), label), label, key=key, booleans_as_int=True)
    rows = stored(rows, "trial-rows")  # counted and split in several passes
    numeric, _ = split_feature_columns(rows, label, exclude=[key])
    train, test = stratified_split(rows, label, key, test_frac, seed, exact=True)
    # each side is read in many passes, which would all draw again
    train, test = stored(train, "trial-train"), stored(test, "trial-held-out")
    check_coverage(train, test, label)
    imputer = KnnImputer(tuple(numeric), key, k).fit(train)
    filled = stored(imputer.transform(train), "trial-filled")
    known = [c for c in numeric if c not in imputer.empty]
    scaler = Standardizer(tuple(known), ddof=0).fit(filled)
    features = [c + scaler.suffix for c in known]
    scaled = scaler.transform(filled)
    training = stored(append_rows(originals(scaled, key, features, label),
                                  smote_balance(scaled, key, features, label, k, seed)), "trial-training")
    model = fit_boosted(training, features, label, "key", params=params)
    asked = stored(scaler.transform(imputer.transform(test)).select(key, label, *features), "trial-test")
    predictions = stored(asked.select(key, label).join(score_boosted(model, asked, key), key), "trial-scores")
    return Trial(derive, imputer, scaler, tuple(features), model, training, predictions,
                 classification_report(predictions, label))
