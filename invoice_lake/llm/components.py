"""Connected components by alternating large-star and small-star steps on an edge table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from invoice_lake.llm.storage import discard, settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node ties its larger neighbours to the smallest node among itself and its neighbours."""
    both = edges.select(F.col("u").alias("node"), F.col("v").alias("peer")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("u").alias("peer")))
    least = both.groupBy("node").agg(F.min("peer").alias("low")).withColumn("low", F.least("low", "node"))
    return both.join(least, "node").where("peer > node").select(F.col("low").alias("u"), F.col("peer").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node ties itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("v").agg(F.min("u").alias("low"))
    moved = edges.join(least, "v").where("u <> low").select(F.col("low").alias("u"), F.col("u").alias("v"))
    return moved.unionByName(least.select(F.col("low").alias("u"), "v")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) give (node, component): each linked node with the smallest node that it can reach.

    Sums per node are combined before any shuffle, and a node with very many links is joined, never
    gathered, so that Spark may split it. Links of a node with itself and null ends are left out; no
    links give no rows.
    """
    edges = settle(
        links.where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        totals = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(totals) == state or totals[0] == 0:
            break
        state, before = tuple(totals), edges
        edges = settle(_small_star(_large_star(before)), "edges")
        discard(before)
    roots = edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(roots)


def forest(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Places of the pairs (a, b) that join two parts which no earlier pair has joined."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    keep = []
    for place, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[x] = y
            keep.append(place)
    return keep
