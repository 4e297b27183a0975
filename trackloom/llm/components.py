"""Connected components of an edge table, without collecting it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.tables import written


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges as stars: each node that is not the smallest of its component, with the smallest."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    rest = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[rest], nodes[label[rest]]


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges, a million at a time, as the stars that connect the same nodes."""
    a = b = np.zeros(0, np.int64)
    for batch in batches:
        a, b = np.concatenate((a, batch.column("a").to_numpy())), np.concatenate((b, batch.column("b").to_numpy()))
        if len(a) > 1_000_000:
            x, y = forest(a, b)
            if 2 * len(x) > len(a):
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])
                x = y = np.zeros(0, np.int64)
            a, b = x, y
    if len(a):
        x, y = forest(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """node, component: the smallest node that is reachable; nodes without an edge to another are left out.

    edges: long columns a and b. Alternates two steps until nothing changes: every node's larger neighbours are hung on
    its smallest one, then its smaller ones. The edges shrink to one per node; each round is written to the shared
    folder, so no lineage grows and a lost executor costs a part of one round. No group is gathered: the smallest
    neighbour is an aggregate that combines before the shuffle, and joining it back is left to Spark's skew handling.
    """

    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).mapInArrow(_thin, "a long, b long").distinct(), "components")
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        edges = written(small.select("a", F.col("m").alias("b")).union(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct(), "components")
        now = edges.agg(F.count("*"), F.sum(F.col("b").cast("decimal(38,0)")), F.sum(F.col("a").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = now
