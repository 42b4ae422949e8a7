"""Connected components: few edges in one task, others by alternating large-star and small-star; and joins that survive hot keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Keys with more rows than this, and than a thousandth of all rows, are hot: there are 1000 of them at most.
HOT_ROWS = 10_000

#: So many edges are joined in one task (16 bytes each, and some times that while it runs); beyond, by rounds.
FEW_EDGES = 1_000_000


def keyed_join(rows: DataFrame, keyed: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """Inner join of rows with a table of one row per key, whose column ``count`` tells the rows of the key. Hot keys, a
    thousand at most by their share of ``total``, are broadcast, so their rows stay where they are; the rest is
    joined by shuffling. keyed should be stored: it is read twice."""
    least = max(HOT_ROWS, total // 1000)
    hot = keyed.filter(F.col(count) > least)
    if total <= least or hot.isEmpty():
        return rows.join(keyed.drop(count), key)
    hot_rows = rows.join(F.broadcast(hot.drop(count)), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return hot_rows.unionByName(rest.join(keyed.filter(F.col(count) <= least).drop(count), key))


def _least(edges: DataFrame, rows: DataFrame, total: int, hot: bool) -> DataFrame:
    """rows (a, b) with m, the smallest neighbour of a along ``edges``. Only where there are hot nodes are the minima stored and
    joined apart for them."""
    if not hot:
        return rows.join(edges.groupBy("a").agg(F.min("b").alias("m")), "a")
    return keyed_join(rows, stored(edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))), "a", "n", total)


def _large_star(edges: DataFrame, total: int, hot: bool) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest in its neighbourhood."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _least(both, both.filter("b > a"), 2 * total, hot).select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def _small_star(edges: DataFrame, total: int, hot: bool) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them. Edges point from larger to smaller."""
    pairs = F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
    return _least(edges, edges, total, hot).select(F.explode(pairs).alias("e")).select("e.*").filter("a <> b").distinct()


def joined(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges a, b and the smallest node that each reaches."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while len(x):
        x, y = label[x], label[y]
        k = x != y
        x, y = x[k], y[k]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(label, up := label[label]):
            label = up
    return nodes, nodes[label]


def _in_one_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    none = np.zeros(0, np.int64)
    parts = [(none, none), *((x["a"].to_numpy(), x["b"].to_numpy()) for x in batches)]
    node, component = joined(*map(np.concatenate, zip(*parts, strict=True)))
    yield pd.DataFrame({"node": node, "component": component})


def components(edges: DataFrame) -> DataFrame:
    """Columns node, component (the smallest node that can be reached) of the nodes of the edges a, b (long). Loops and
    repeated edges don't matter; without edges the result is empty. Few edges take one task, as a round has some ten stages of as many
    tasks as there are partitions, however small; of more every round is checkpointed."""
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    if now.count() <= FEW_EDGES:
        return now.coalesce(1).mapInPandas(_in_one_task, "node long, component long")

    def state(e: DataFrame) -> tuple[int, object, int]:
        """Edges, a checksum of them, and the most edges of a node, in one job."""
        ends = e.select("a", F.xxhash64("a", "b").alias("h")).union(e.select("b", F.xxhash64("a", "b")))
        per = ends.groupBy("a").agg(F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("h"))
        x = per.agg(F.sum("n"), F.sum("h"), F.max("n")).first()
        return (x[0] or 0) // 2, x[1], x[2] or 0

    last, mark = None, state(now)
    while mark != last and mark[0]:
        # a large star leaves no node with more smaller neighbours than it had neighbours
        hot = mark[2] > HOT_ROWS
        now = stored(_small_star(_large_star(now, mark[0], hot), mark[0], hot))
        last, mark = mark, state(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
