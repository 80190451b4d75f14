from riskframe.plans.augmented import augment_table
from riskframe.plans.explore import Exploration, explore
from riskframe.plans.prepare import Preparation, PreparedModel
from riskframe.plans.train import (build_stages, feature_importance, fit_model, score,
                                   train_and_evaluate)
from riskframe.plans.trial import Trial, run_trial

__all__ = ["Exploration", "Preparation", "PreparedModel", "Trial", "augment_table", "build_stages", "explore",
           "feature_importance", "fit_model", "run_trial", "score", "train_and_evaluate"]
