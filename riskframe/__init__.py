"""Tabular binary-risk modelling on Spark DataFrames.

``sources``   reading and writing tables and fitted models
``functions`` column expressions shared by the operators
``operators`` one module per family: clean, impute, features, sampling,
              augment, evaluate, profile
``plans``     the end-to-end jobs: prepare, train and score, augment
"""

from riskframe.spec import DIABETES, HEART, DatasetSpec

__all__ = ["DIABETES", "HEART", "DatasetSpec"]
