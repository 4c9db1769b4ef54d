"""Connected components by alternating large-star and small-star steps.

Before each round, runs of ``RUN`` edges become stars within their tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

# Edges that a task holds at once, whatever the input: 1 MB of ids.
RUN = 1 << 16


def _forest(u: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Every node of the edges with the smallest one it is connected with by them."""
    nodes, at = np.unique(np.concatenate((u, n)), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        lo, hi = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        if np.array_equal(lo, hi):
            break
        # At least every second root that has edges left goes below another.
        np.minimum.at(root, hi, lo)
        while not np.array_equal(up := root[root], root):
            root = up
    below = np.flatnonzero(root != np.arange(len(nodes)))
    return pa.RecordBatch.from_arrays([pa.array(nodes[below]), pa.array(nodes[root[below]])], names=["u", "n"])


def _contracted(pairs: DataFrame) -> tuple[DataFrame, bool]:
    """Stars with the components of ``pairs(u, n)`` in each run of edges, and whether there is but one run."""
    runs = -(-pairs.count() // RUN)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, RUN):
                part = batch.slice(at, RUN)
                if size + part.num_rows > RUN:
                    yield _forest(*(np.concatenate(c) for c in zip(*held, strict=True)))
                    held, size = [], 0
                held.append([c.to_numpy() for c in part.columns])
                size += part.num_rows
        if held:
            yield _forest(*(np.concatenate(c) for c in zip(*held, strict=True)))

    stars = pairs.coalesce(max(runs, 1)).mapInArrow(work, "u long, n long")
    return materialize(stars, "stars"), runs <= 1


def _lowest(pairs: DataFrame) -> DataFrame:
    """The smallest of every ``u`` and all its ``n`` as ``lo``.

    Joins with it are merged: a broadcast would need a step more, and Spark splits hot keys.
    """
    lowest = pairs.groupBy("u").agg(F.min("n").alias("lo"))
    return lowest.select("u", F.least("u", "lo").alias("lo")).hint("merge")


def _both_ways(*pairs: tuple) -> Column:
    """One row ``p(u, n)`` for each of the pairs of columns."""
    return F.explode(F.array(*[F.struct(F.col(u).alias("u"), F.col(n).alias("n")) for u, n in pairs])).alias("p")


def _settled(stars: DataFrame) -> bool:
    """Every node has one smaller neighbour, though perhaps repeatedly, or larger ones alone."""
    ends = stars.select(_both_ways(("u", "n"), ("n", "u"))).select("p.*")
    ends = ends.groupBy("u").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    return ends.where("lo < u and lo < hi").agg(F.count("*")).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; the component is its smallest node.

    Each round joins the edges with their per-node minimum, so no node's
    neighbours are gathered, and a hot node is combined map-side and split by
    AQE.  Rounds are written to the shared folder.  Their number grows with the
    logarithm of the longest path; none follows once every component is a star.
    Loops and null ends are ignored; no edges give an empty result.
    """
    pairs = edges.where("a != b").select(F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("n"))
    pairs = materialize(pairs, "edges")
    while True:
        stars, whole = _contracted(pairs)
        if whole or _settled(stars):
            break
        lowest = _lowest(stars.select(_both_ways(("u", "n"), ("n", "u"))).select("p.*"))
        # Repeated pairs change no minimum and go at the end of the round.
        large = stars.toDF("of", "u").join(lowest, "u").select(F.col("of").alias("u"), F.col("lo").alias("n"))
        small = large.join(_lowest(large), "u").select(_both_ways(("u", "lo"), ("n", "lo")))
        pairs = materialize(small.select("p.*").where("u != n").distinct(), "pairs")
    if not whole:
        stars = stars.distinct()
    return stars.select(F.col("u").alias("node"), F.col("n").alias("component")).union(
        stars.select("n", "n").distinct()
    )
