"""Ridge regression by normal equations: one aggregate over the rows, one small system on the driver.

The aggregate holds the means and all covariances of features and label. Each task adds up its rows, so that one row per
task is shuffled however many rows there are. The system has as many unknowns as features.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RidgeFit:
    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float

    def value(self) -> Column:
        """The prediction of a row; null where a feature is."""
        total = F.lit(self.intercept)
        for name, weight in zip(self.features, self.coefficients, strict=True):
            total = total + F.lit(weight) * F.col(name).cast("double")
        return total

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", self.value())


def gram(df: DataFrame, features: Sequence[str], label: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, means and covariances (divided by the rows) of features and label, the label last."""
    names = [*features, label]
    value = {n: F.col(n).cast("double") for n in names}
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(value[n]).alias(f"m{i}") for i, n in enumerate(names)],
        *[F.covar_pop(value[names[i]], value[names[j]]).alias(f"c{i}_{j}") for i, j in pairs],
    ).first()
    if not row.n:
        raise ValueError("no rows to fit")
    spread = np.zeros((len(names), len(names)))
    for i, j in pairs:
        spread[i, j] = spread[j, i] = row[f"c{i}_{j}"]
    return row.n, np.array([row[f"m{i}"] for i in range(len(names))]), spread


def fit_ridge(df: DataFrame, features: Sequence[str], label: str, reg_param: float) -> RidgeFit:
    """Least squares with an L2 penalty on standardised features and label, and a free intercept.

    The penalty is that of MLlib's solver: ``reg_param`` over the label's deviation times each feature's variance. Constant
    features get no weight, and a constant label is its own prediction. Rows must be complete; without rows it is an error.
    """
    _, mean, spread = gram(df, features, label)
    deviation = math.sqrt(spread[-1, -1])
    variance = np.diag(spread)[:-1]
    weights = np.zeros(len(variance))
    some = np.flatnonzero(variance > 0)
    if deviation > 0 and len(some):
        system = spread[np.ix_(some, some)] + np.diag(reg_param / deviation * variance[some])
        weights[some] = np.linalg.lstsq(system, spread[some, -1], rcond=None)[0]
    return RidgeFit(tuple(features), tuple(weights.tolist()), float(mean[-1] - weights @ mean[:-1]))
