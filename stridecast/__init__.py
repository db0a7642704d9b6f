"""Walk-forward forecasting on Spark DataFrames."""

from stridecast.config import FeatureSpec, ForestParams

__all__ = ["FeatureSpec", "ForestParams"]
