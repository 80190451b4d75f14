from riskframe.functions.columns import known, numeric_columns, value_map
from riskframe.functions.keyed_random import normal, uniform

__all__ = ["known", "normal", "numeric_columns", "uniform", "value_map"]
