"""Connected components of a graph given by edges between long ids, by alternating large and small stars.

Tasks, shuffles and checkpoints are counted here more than rows, as most graphs are small: what a task holds is merged in
one go, so that a round takes three shuffles, few rounds are left, and none is spent to see that nothing changes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.shared import column_of, saved, tidy

_AT_ONCE = 1 << 19  # edges that a task merges at once


def merged(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges to the least vertex of its component from every other vertex of these edges."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, root = at[: len(a)], at[len(a) :], np.arange(len(ids))
    while True:
        x, y = root[x], root[y]
        apart = x != y
        if not apart.any():
            break
        x, y = x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    moved = root != np.arange(len(ids))
    return ids[moved], ids[root[moved]]


def _merged(edges: DataFrame) -> DataFrame:
    """Small star: the smaller neighbours of a vertex and the vertex move to the least of them. Tasks merge the edges they
    have before the shuffle, so that each sends one edge of a vertex at most, and all that they get after it."""

    def run(batches, whole_groups: bool):
        held, n = [], 0
        for batch in batches:
            held.append([column_of(batch, name).to_numpy() for name in ("a", "b")])
            n += batch.num_rows
            if n >= _AT_ONCE:
                a, b = (np.concatenate(x) for x in zip(*held))
                # Where rows come sorted by a, the edges of one vertex stay together.
                end = int(np.searchsorted(a, a[-1])) if whole_groups else n
                yield pa.record_batch([pa.array(x) for x in merged(a[:end], b[:end])], ["a", "b"])
                held, n = [[a[end:], b[end:]]], n - end
        if n:
            yield pa.record_batch([pa.array(x) for x in merged(*(np.concatenate(x) for x in zip(*held)))], ["a", "b"])

    sent = edges.mapInArrow(tidy(lambda batches: run(batches, False)), "a long, b long").repartition("a")
    return sent.sortWithinPartitions("a").mapInArrow(tidy(lambda batches: run(batches, True)), "a long, b long")


def _raised(edges: DataFrame) -> DataFrame:
    """Large star: every larger neighbour of a vertex moves to the least of its neighbourhood. As ``b`` is the less of an
    edge, that is the least ``b`` of the edges that have it as ``a``. Minima are aggregated before the shuffle, and a
    vertex of many edges is joined, not gathered."""
    least = edges.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("m"))
    return edges.join(least, "b", "left").select("a", F.coalesce("m", "b").alias("b"))


def _settled(edges: DataFrame) -> bool:
    """Whether every vertex has one edge to a smaller one that has none."""
    ends = F.array(*(F.struct(F.col(name).alias("vertex"), F.lit(n).alias("below"), F.lit(1 - n).alias("above")) for name, n in (("a", 1), ("b", 0))))
    seen = edges.select(F.explode(ends).alias("end")).groupBy("end.vertex").agg(F.sum("end.below").alias("below"), F.max("end.above").alias("above"))
    return seen.filter("below > 0 and below + above > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``vertex`` and ``root``, the least vertex it is connected with, for every vertex of an edge (``a``, ``b``).

    Vertices without an edge are left out; an edge from a vertex to itself says nothing; no edges give no rows.
    """
    edges = saved(_merged(edges.filter("a <> b").select("a", "b")))
    while not _settled(edges):
        edges = saved(_merged(_raised(edges)))
    return edges.select(F.col("a").alias("vertex"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct())
