"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.shared import written


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): for every end of an edge (columns ``a`` and ``b``, long)
    the smallest node it reaches. Null ends and loops are left out.

    A round moves every node's larger neighbours to its smallest neighbour
    (large star), then its smaller ones (small star); rounds grow with the
    logarithm of the longest path. Each round is a written table, so a lost
    executor repeats one round at most; minima are pre-aggregated before they
    are shuffled, and joins on a node that most edges share can be split."""
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    mark = None
    while True:
        both = _both(now)
        low = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("at"), F.least("low", "a").alias("low"))
        large = both.where("b > a").join(low, F.col("a") == F.col("at")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low")).withColumnRenamed("a", "at")
        small = large.join(least, F.col("a") == F.col("at")).where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = small.unionByName(least.select(F.col("at").alias("a"), F.col("low").alias("b")))
        now = written(small.distinct(), name)
        found = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.count_distinct("a")).first()
        if found[0] == found[2] and found[:2] == mark:      # every node has one parent, and nothing moved
            roots = now.select(F.col("b").alias("node")).distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                roots.select("node", F.col("node").alias("component")))
        mark = found[:2]


def stars(ids: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every node of the pairs to the least node it reaches."""
    nodes, at = np.unique(np.concatenate([ids, others]), return_inverse=True)
    a, b = at[:len(ids)], at[len(ids):]
    low = np.arange(len(nodes))
    while True:
        before = low.copy()
        np.minimum.at(low, a, low[b])
        np.minimum.at(low, b, low[a])
        low = low[low]
        if (low == before).all():
            moved = low != np.arange(len(nodes))
            return nodes[moved], nodes[low[moved]]
