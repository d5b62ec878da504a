"""Connected components of a link table, in Spark throughout."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.llm.storage import stage


def components(links: DataFrame, *by: str, most_rounds: int = 100) -> DataFrame:
    """``node`` and ``component`` (the smallest node reached) of every node of ``links`` (``a``, ``b``: long).

    Columns ``by`` tell graphs apart that are solved together. Alternating large and small stars: every node hands its
    smallest neighbour to its larger ones, then to its smaller ones, until all nodes hang on their component's
    smallest. Minima are aggregated before they move, and a star with a third of all links is joined to its one
    minimum, a join that Spark can split; each round is written to the shared folder. Loops and repeated links do no
    harm; rows with a null end are no links. An empty table gives an empty one.
    """
    col, w = F.col, [*by, "w"]
    edges = links.where(col("a").isNotNull() & col("b").isNotNull() & (col("a") != col("b")))
    edges = stage(edges.select(*by, F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    mark = _mark(edges, by)
    for _ in range(most_rounds):
        if not mark[0]:
            break
        # Large star: larger neighbours of u go to the smallest neighbour of u, or to u.
        both = edges.unionByName(edges.select(*by, col("v").alias("u"), col("u").alias("v")))
        least = both.groupBy(*by, "u").agg(F.least(F.min("v"), col("u")).alias("m")).withColumnRenamed("u", "w")
        upward = edges.select(*by, col("v").alias("w"), col("u").alias("x"))
        large = upward.join(least, w).where("x <> m").select(*by, col("x").alias("u"), col("m").alias("v"))
        large = stage(large, "large-star")
        # Small star: u and its smaller neighbours go to the smallest of them.
        least = large.groupBy(*by, "u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
        joined = large.select(*by, col("u").alias("w"), col("v").alias("x")).join(least, w)
        small = joined.select(*by, col("x").alias("u"), col("m").alias("v")).unionByName(least.select(*by, col("w").alias("u"), col("m").alias("v")))
        edges = stage(small.where("u <> v").distinct(), "small-star")
        before, mark = mark, _mark(edges, by)
        if before == mark:
            break
    else:
        raise RuntimeError(f"no fixed point after {most_rounds} rounds")
    leaves = edges.select(*by, col("u").alias("node"), col("v").alias("component"))
    return leaves.unionByName(edges.select(*by, col("v").alias("node"), col("v").alias("component")).distinct())


def _mark(edges: DataFrame, by: tuple[str, ...]) -> tuple:
    """Number and order-free checksum of the links."""
    h = F.xxhash64(*by, "u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(h), F.lit(0))).first())


def forest(links: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray) -> np.ndarray:
    """For the nodes of both sides (``a`` first) the smallest id that a boolean link matrix lets them reach."""
    top = np.iinfo(np.int64).max
    left, right = ids_a.astype(np.int64), ids_b.astype(np.int64)
    while True:
        new_left = np.minimum(left, np.where(links, right[None, :], top).min(axis=1, initial=top))
        new_right = np.minimum(right, np.where(links, new_left[:, None], top).min(axis=0, initial=top))
        if (new_left == left).all() and (new_right == right).all():
            return np.concatenate([left, right])
        left, right = new_left, new_right
