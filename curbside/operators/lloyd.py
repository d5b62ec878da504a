"""KMeans as Lloyd rounds of aggregates, from a fixed start: the same clusters for any partitioning.

The start is the row of the lowest key, then, one by one, the row farthest from all centres so far. A round gives every row to
its nearest centre and averages the rows of each centre; rows are summed on the map side, so that a round shuffles one row
per centre and task, and only the centres reach the driver. Rounds end when the centres stay where they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Centres that move by less than this (in deviations) stay where they are: sums in another order differ by as much.
STILL = 1e-12

#: Column of the standardised features while centres are sought.
POINT = "point"

Centers = list[list[float]]


@dataclass(frozen=True)
class Scale:
    """Means and sample deviations of the features."""

    names: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]

    def columns(self) -> list[Column]:
        """Each feature in deviations from its mean; 0 for a constant one."""
        parts = zip(self.names, self.means, self.deviations, strict=True)
        return [(F.col(n).cast("double") - m) / s if s > 0 else F.lit(0.0) for n, m, s in parts]


@dataclass(frozen=True)
class LloydFit:
    scale: Scale
    centers: Centers
    rounds: int

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``raw_features``, the standardised ``features``, and ``cluster``, from 0; ties go to the first centre."""
        rows = VectorAssembler(inputCols=list(self.scale.names), outputCol="raw_features").transform(df)
        point = F.array(*self.scale.columns())
        return rows.withColumns({"features": array_to_vector(point), "cluster": nearest(squares(point, self.centers))})


def measure(df: DataFrame, names: Sequence[str]) -> Scale:
    row = df.agg(*[f(F.col(n).cast("double")).alias(f"{k}{i}") for i, n in enumerate(names) for k, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
    return Scale(tuple(names), *(tuple(row[f"{k}{i}"] or 0.0 for i in range(len(names))) for k in "ms"))


def squares(point: Column, centers: Centers) -> Column:
    """Squared distances to all centres, as an array. The centres are one constant, which the generated code does not
    contain: all rounds share it."""

    def apart(center: Column) -> Column:
        parts = F.zip_with(point, center, lambda v, w: (v - w) * (v - w))
        return F.aggregate(parts, F.lit(0.0), lambda total, part: total + part)

    return F.transform(F.array(*[F.array(*map(F.lit, c)) for c in centers]), apart)


def nearest(distances: Column) -> Column:
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")


def farthest_points(rows: DataFrame, key: str, k: int) -> Centers:
    """The start: at most ``k`` different points; fewer if the rows have no more. Equally far ones go by key."""
    first = rows.agg(F.min_by(POINT, key)).first()[0]
    centers = [first] if first else []
    while centers and len(centers) < k:
        far = rows.select(key, POINT, F.array_min(squares(F.col(POINT), centers)).alias("away"))
        best = far.agg(F.min_by(F.struct(POINT, "away"), F.struct(-F.col("away"), F.col(key))).alias("best")).first().best
        if not best.away > 0:
            break
        centers.append(best[POINT])
    return centers


def rounds(rows: DataFrame, centers: Centers, max_iter: int) -> tuple[Centers, int]:
    """Centres after at most ``max_iter`` rounds, and how many it took. A centre that loses all rows stays."""
    size = len(centers[0]) if centers else 0
    for done in range(max_iter if centers else 0):
        own = rows.select(POINT, squares(F.col(POINT), centers).alias("away")).select(POINT, nearest(F.col("away")).alias("cluster"))
        means = own.groupBy("cluster").agg(F.array(*[F.avg(F.col(POINT)[i]) for i in range(size)]).alias("mean"))
        found = {r.cluster: r["mean"] for r in means.collect()}
        moved = [found.get(i, center) for i, center in enumerate(centers)]
        far = max(abs(a - b) for x, y in zip(moved, centers, strict=True) for a, b in zip(x, y, strict=True))
        centers = moved
        if far <= STILL:
            return centers, done + 1
    return centers, max_iter


def prepare(df: DataFrame, key: str, names: Sequence[str]) -> tuple[DataFrame, Scale]:
    """The key and the standardised features as an array, for the rounds to read; the caller keeps and releases the rows."""
    scale = measure(df, names)
    return df.select(key, F.array(*scale.columns()).alias(POINT)), scale


def cost(rows: DataFrame, centers: Centers) -> float:
    """Sum of squared distances to the nearest centre."""
    return float(rows.agg(F.sum(F.array_min(squares(F.col(POINT), centers)))).first()[0] or 0.0)
