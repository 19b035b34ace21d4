"""Connected components of a stored graph."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spelltide.llm.scratch import stored


#: Edges that a task holds to reduce them to a forest.
MOST_EDGES = 1 << 20


def _contracted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the smallest node that these edges connect it with."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = places[: len(a)], places[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if np.array_equal(root, before):
            moved = root != np.arange(len(nodes))
            return nodes[moved], nodes[root[moved]]


def _forest(batches: Iterator[pa.RecordBatch]):
    """A forest of a task's edges, or of each million of them."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        if sum(len(a) for a, _ in held) >= MOST_EDGES:
            held = [_contracted(*map(np.concatenate, zip(*held)))]
            if len(held[0][0]) >= MOST_EDGES // 2:
                yield pa.RecordBatch.from_arrays([*map(pa.array, held.pop())], ["a", "b"])
    if held:
        yield pa.RecordBatch.from_arrays([*map(pa.array, _contracted(*map(np.concatenate, zip(*held))))], ["a", "b"])


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller one, its root, or is a root."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionAll(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    both = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return both.where("up > 1 or up = 1 and down = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge to another and is not its component's smallest, the root.

    `edges` has longs a and b in any order, repeated or not; loops and nulls are left out. First each
    task replaces its edges by a forest, then large-star and small-star steps alternate until every edge
    leads to a root. Every step is written to the shared folder, and each node's smallest neighbour is joined
    from storage, so AQE can split the edges of a hub.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stored(now.mapInArrow(_forest, "a long, b long").distinct(), "stars")
    while not _are_stars(now):
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "star-least")
        # Edges lead to the smaller node, so these are all from a node to a larger one, straight from storage.
        large = now.select(F.col("b").alias("a"), F.col("a").alias("b")).join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.distinct(), "stars")
        if _are_stars(large):
            now = large
            break
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "star-least")
        small = large.join(least.hint("merge"), "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(small.unionAll(least.select("a", F.col("m").alias("b"))).distinct(), "stars")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
