"""Gradient-boosted regression trees by split search on histograms.

Each feature is cut once into bins of one width. A tree grows level by level; a level is one aggregate of all rows, the sums of the residuals
per node, feature and bin, which tasks add up on the map side, so that at most nodes x features x bins rows per task are
shuffled however many rows there are. Windows over these sums find every node's best split in Spark; only the splits reach
the driver. Equal gains go to the first feature, then to the lowest cut, so that a fit is the same for any partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A split must lessen the squared error by more than this share of the node's sum of squares.
LEAST_GAIN = 1e-9


@dataclass(frozen=True)
class Split:
    tree: int
    node: int  # the root is 1; below node n are 2 n (value up to the cut) and 2 n + 1
    feature: int
    bin: int  # the last one on the left side
    cut: float
    gain: float


@dataclass(frozen=True)
class BoostedFit:
    features: tuple[str, ...]
    start: float
    splits: tuple[Split, ...]
    leaves: tuple[dict[int, float], ...]  # of each tree: what a leaf adds, its step included

    def value(self) -> Column:
        """The prediction of a row."""
        total = F.lit(self.start)
        for tree, leaves in enumerate(self.leaves):
            total = total + self._subtree({s.node: s for s in self.splits if s.tree == tree}, leaves, 1)
        return total

    def _subtree(self, splits: dict[int, Split], leaves: dict[int, float], node: int) -> Column:
        if node not in splits:
            return F.lit(leaves[node])
        split = splits[node]
        left, right = (self._subtree(splits, leaves, 2 * node + side) for side in (0, 1))
        return F.when(F.col(self.features[split.feature]).cast("double") <= split.cut, left).otherwise(right)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", self.value())

    def importances(self) -> dict[str, float]:
        """The share of each feature in the gains of all splits; 0 for a feature that splits nowhere."""
        total = sum(s.gain for s in self.splits)
        return {name: sum(s.gain for s in self.splits if s.feature == i) / total if total else 0.0 for i, name in enumerate(self.features)}


def cuts_of(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Where each feature is cut: at even steps from its smallest value to its largest. A constant one is not."""
    value = {n: F.col(n).cast("double") for n in features}
    row = df.agg(*[f(value[n]).alias(f"{k}{i}") for i, n in enumerate(features) for k, f in (("low", F.min), ("high", F.max))]).first()
    ends = [(row[f"low{i}"], row[f"high{i}"]) for i in range(len(features))]
    return [[low + (high - low) * j / bins for j in range(1, bins)] if low is not None and low < high else [] for low, high in ends]


def fit_boosted(df: DataFrame, features: Sequence[str], label: str, trees: int, depth: int, step: float, bins: int = 32) -> BoostedFit:
    """Squared-error boosting: the first tree counts whole, later ones by ``step``. Rows must be complete.

    The rows are kept while they are read, one pass for each level of each tree, and released.
    """
    cuts = cuts_of(df, features, bins)
    binned = [_bin(F.col(n).cast("double"), c).alias(f"b{i}") for i, (n, c) in enumerate(zip(features, cuts, strict=True))]
    rows = df.select(*[F.col(n).cast("double").alias(n) for n in features], F.col(label).cast("double").alias("y"), F.array(*binned).alias("bins")).persist()
    splits: list[Split] = []
    leaves: list[dict[int, float]] = []
    try:
        for tree in range(trees):
            so_far = BoostedFit(tuple(features), 0.0, tuple(splits), tuple(leaves))
            found, values = grow(rows.select("bins", (F.col("y") - so_far.value()).alias("e")), cuts, depth, tree)
            splits += found
            leaves.append({node: v * (step if tree else 1.0) for node, v in values.items()})
    finally:
        rows.unpersist()
    return BoostedFit(tuple(features), 0.0, tuple(splits), tuple(leaves))


def _bin(value: Column, cuts: list[float]) -> Column:
    """How many cuts lie below the value: up to the cut of number b, the bin is b at most."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < value)) if cuts else F.lit(0)


def grow(rows: DataFrame, cuts: list[list[float]], depth: int, tree: int) -> tuple[list[Split], dict[int, float]]:
    """Splits and leaf means of one tree on ``bins`` and residuals ``e``."""
    splits: dict[int, Split] = {}
    means: dict[int, float] = {}
    for level in range(depth + 1):
        node = _node(splits, 1, level)
        placed = rows.select(node.alias("node"), "bins", "e").where(F.col("node") >= 1 << level)
        if level == depth:
            means |= {r.node: r.mean for r in placed.groupBy("node").agg(F.avg("e").alias("mean")).collect()}
            break
        sums = placed.select("node", "e", F.posexplode("bins").alias("feature", "bin"))
        sums = sums.groupBy("node", "feature", "bin").agg(F.sum("e").alias("s"), F.sum(F.col("e") * F.col("e")).alias("q"), F.count(F.lit(1)).alias("n"))
        best = best_splits(sums).collect()
        if not best:
            break
        for r in best:
            means[r.node] = r.mean
            if r.gain is not None:
                splits[r.node] = Split(tree, r.node, r.feature, r.bin, cuts[r.feature][r.bin], r.gain)
        if not any(r.gain is not None for r in best):
            break
    return list(splits.values()), {n: v for n, v in means.items() if n not in splits}


def best_splits(sums: DataFrame) -> DataFrame:
    """Mean of each node, and its best split: feature, last bin of the left side, gain; nulls where none gains."""
    feature = Window.partitionBy("node", "feature")
    upto = feature.orderBy("bin")
    left = sums.select(
        "node", "feature", "bin",
        F.sum("s").over(upto).alias("ls"), F.sum("n").over(upto).alias("ln"),
        F.sum("s").over(feature).alias("s"), F.sum("n").over(feature).alias("n"), F.sum("q").over(feature).alias("q"),
    )
    other = F.col("n") - F.col("ln")
    gain = F.when(other > 0, F.col("ls") * F.col("ls") / F.col("ln") + (F.col("s") - F.col("ls")) * (F.col("s") - F.col("ls")) / other - F.col("s") * F.col("s") / F.col("n"))
    gain = F.round(gain, 6)
    good = left.withColumn("gain", F.when(gain > LEAST_GAIN * F.col("q"), gain))
    order = F.struct(F.coalesce(-F.col("gain"), F.lit(float("inf"))).alias("o"), "feature", "bin")
    best = good.groupBy("node").agg(F.min_by(F.struct("feature", "bin", "gain", (F.col("s") / F.col("n")).alias("mean")), order).alias("b"))
    return best.select("node", "b.*")


def _node(splits: dict[int, Split], at: int, levels: int) -> Column:
    """The node in which a row stands: its number, down to ``levels`` below ``at``."""
    if at not in splits or not levels:
        return F.lit(at)
    split = splits[at]
    left, right = (_node(splits, 2 * at + side, levels - 1) for side in (0, 1))
    return F.when(F.col("bins")[split.feature] <= split.bin, left).otherwise(right)
