"""Connected components of a link table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from corpusloom.session import materialize


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same nodes as ``(a, b)`` with at most one row per node: every node but
    the smallest of its group, and that smallest."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = place[:len(a)], place[len(a):]
    root = np.arange(len(nodes))
    while True:
        ri, rj = root[i], root[j]
        low, high = np.minimum(ri, rj), np.maximum(ri, rj)
        open_ = low != high
        if not open_.any():
            break
        i, j, low, high = i[open_], j[open_], low[open_], high[open_]
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[child], nodes[root[child]]


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``links(u, v)``: root is the least node it can reach.

    Large-star and small-star in turn until nothing changes; each round is a written table. Minima
    are combined before the shuffle, so a hub of any degree is one row per task there.
    """
    now = materialize(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .where("u <> v").distinct(), "links")
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"),
                                                            F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select("u", F.col("m").alias("v")).union(
            joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        before, now = now, materialize(small, "links")
        # Both are sets, so they are the same if they are equally many and none is new.
        if now.count() == before.count() and not now.join(
                before, ["u", "v"], "left_anti").head(1):
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
