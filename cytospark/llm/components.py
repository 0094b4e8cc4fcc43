"""Connected components of an edge table, by minimum labels and pointer jumping."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Observation, functions as F

from ..scratch import discard, materialise


def _told(edges: DataFrame, least: DataFrame) -> DataFrame:
    """``edges`` with ``m``, what ``least`` says of their node ``a``.

    The join goes by a value that stands for ``a``, so both sides are dealt out for it,
    and Spark may split the partition of a node with very many edges.
    """
    key = F.bitwise_not("a")
    return edges.withColumn("k", key).join(least.select(key.alias("k"), "m"), "k").drop("k")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node that an edge joins to another; the component is its smallest node.

    Each round, every node hangs all larger neighbours on its smallest one and then
    every node hangs itself on the smallest it knows, which turns components into stars
    in a logarithmic number of rounds; when a round changes no edge, all are stars. Each
    round is one write, and later rounds restart from it. Self loops and repeated edges
    do no harm; nulls are left out.
    """
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null and a <> b")
    e = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    before = None
    for _ in range(most_rounds):
        seen = Observation()
        new = materialise(e, "edges", seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"))
        now = (seen.get["n"], seen.get["x"])
        if before is not None:
            discard(old)
        old = new
        if now == before or not now[0]:
            break
        before = now
        # Large star: each node's larger neighbours get its smallest neighbour (or itself).
        both = new.union(new.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = _told(both.filter("b > a"), least).select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: each node's smaller neighbours, and itself, get the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = _told(large, low).select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        e = small.filter("a <> b").distinct()
    else:
        raise RuntimeError("components did not settle")
    out = old.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = out.union(old.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
    out._scratch = old._scratch
    return out


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over the edges ``a``-``b``."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    return label
