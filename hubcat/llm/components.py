"""Connected components of an edge table, by alternating stars; nothing but counts reaches the driver."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hubcat.operators.skew import join_unique
from hubcat.session import drop_stored, stored_at

#: Edges that a task gathers between two joins of them, and nodes that it holds at most before it hands them on, about.
GATHERED, MOST_NODES = 1_000_000, 2_000_000


def _to_smallest(edges: DataFrame, larger: bool) -> DataFrame:
    """Hang a node's neighbours (the larger ones, or the smaller ones and itself) on the smallest of them.

    The smallest neighbour comes from a grouping with a partial step, and is joined back, so
    that a node with very many neighbours is split as a skewed join.
    """
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else edges
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    hung = join_unique(both, least, "a", "inner")
    if larger:
        return hung.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
    return hung.select(F.col("b").alias("a"), F.col("low").alias("b")).union(least.select("a", F.col("low").alias("b"))).where("a <> b").distinct()


def joined(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of the links a to b, and the smallest node that links reach from it."""
    node, ends = np.unique(np.r_[a, b], return_inverse=True)
    a, b = ends[:len(a)], ends[len(a):]
    label = np.arange(len(node))
    while True:
        # Of two labels that meet, the larger one hangs on the smaller; then every node takes its root.
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        if (low == high).all():
            return node, node[label]
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges as stars: its nodes hang on the smallest one that they reach there. Of long tasks, so many edges at a time."""
    node, root, held = np.zeros(0, "i8"), np.zeros(0, "i8"), 0
    for batch in batches:
        node, root = np.r_[node, batch.column(0).to_numpy()], np.r_[root, batch.column(1).to_numpy()]
        if len(node) >= 2 * held + GATHERED:
            node, root = joined(node, root)
            held = len(node)
            if held >= MOST_NODES:
                yield _stars_of(node, root)
                node, root, held = node[:0], root[:0], 0
    yield _stars_of(*joined(node, root))


def _stars_of(node: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
    apart = node != root
    return pa.RecordBatch.from_arrays([pa.array(node[apart]), pa.array(root[apart])], names=["a", "b"])


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one other at most, and those that others hang on hang on none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("held")).union(edges.select("b", F.lit(0), F.lit(1)))
    twice = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("held").alias("held")).where("hangs + held > 1")
    return not twice.agg(F.count(F.lit(1))).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """node, label for every node of the edges ``a``, ``b`` (longs): the smallest node that it reaches.

    A round first joins what lies in one task, whatever edges that are, then hangs neighbours on the smallest one over all
    tasks. It is written to the shared folder, the one before goes; one grouping tells whether another is needed. Rounds
    grow with the logarithm of a component's size, not with its diameter. Loops and repeated edges do no harm; no edges
    give no rows.
    """
    now, path = stored_at(edges.where("a <> b").mapInArrow(_contracted, "a long, b long").distinct(), "edges")
    while not _are_stars(now):
        before = path
        now, path = stored_at(_to_smallest(_to_smallest(now, True), False).mapInArrow(_contracted, "a long, b long").distinct(), "edges")
        drop_stored(edges.sparkSession, before)
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(now.select(F.col("b"), F.col("b")).distinct())
