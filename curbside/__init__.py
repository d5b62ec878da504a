"""Trip-demand and site-selection analytics as composable PySpark operators."""

from curbside.params import Params

__all__ = ["Params"]
