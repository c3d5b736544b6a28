"""Entity time-series preparation, labelling and model evaluation on Spark DataFrames."""

from wardline.config import Settings

__all__ = ["Settings"]
