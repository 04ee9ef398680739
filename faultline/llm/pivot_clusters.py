"""Exact k-means over integer vectors with a LAESA table: distances of every vector to fixed pivots, stored once.

By the triangle inequality a vector is at least as far from a centroid as their distances to any pivot differ. In each
round centroids are visited in order of that bound; their exact integer distances are taken until no bound is below the
nearest so far.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.shared import column_of, saved

#: Components lie below this, so that squared distances of 64 of them stay within 64 bits.
LARGEST = 1 << 27


def spread_pivots(sample: np.ndarray, pivots: int) -> np.ndarray:
    """Vectors of the sample far from each other: the first, then always the one farthest from those chosen."""
    chosen = [0]
    far = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(pivots, len(sample)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def distances(vectors: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all ``others``, which are few."""
    return np.stack([((vectors - x) ** 2).sum(1) for x in others], 1)


def nearest(vectors: np.ndarray, table: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each vector (ties: smaller number), its squared distance, and how many distances were taken.

    ``table`` holds the vectors' distances to the pivots. Bounds are lowered by more than doubles can be off, so none
    excludes a centroid that ties.
    """
    to_pivots = np.sqrt(distances(centroids, pivots).astype(np.float64))
    bounds = np.zeros((len(vectors), len(centroids)))
    for p in range(len(pivots)):
        np.maximum(bounds, np.abs(table[:, p : p + 1] - to_pivots[:, p]), out=bounds)
    bounds = np.maximum(bounds * (1 - 1e-9) - 1e-6 * (1 + table.max(initial=0) * 1e-6), 0) ** 2
    order = bounds.argsort(1, kind="stable")
    best = np.full(len(vectors), np.iinfo(np.int64).max)
    where = np.zeros(len(vectors), np.int64)
    active, taken = np.arange(len(vectors)), 0
    for step in range(len(centroids)):
        near = order[active, step]
        going = bounds[active, near] <= best[active]
        active, near = active[going], near[going]
        if not len(active):
            break
        found = ((vectors[active] - centroids[near]) ** 2).sum(1)
        taken += len(active)
        better = (found < best[active]) | ((found == best[active]) & (near < where[active]))
        best[active[better]], where[active[better]] = found[better], near[better]
    return where, best, taken


def _matrix(column, width: int, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def usable(vectors: DataFrame, size: int, scale: int, id_column: str, vector_column: str) -> DataFrame:
    """``id`` and ``vector`` (floor(scale * x)) of rows with ``size`` finite components. One of ``LARGEST`` or more raises."""
    finite = F.forall(vector_column, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    scaled = lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")
    checked = lambda x: F.when(F.abs(F.lit(float(scale)) * x.cast("double")) < LARGEST - 1, scaled(x)).otherwise(
        F.raise_error(F.lit(f"a component is too large: squared distances of numbers of {LARGEST} leave 64 bits")).cast("long"))
    rows = vectors.filter(F.col(vector_column).isNotNull() & (F.size(vector_column) == size) & finite)
    return rows.select(F.col(id_column).alias("id"), F.transform(vector_column, checked).alias("vector"))


def cluster(vectors: DataFrame, clusters: int = 40, rounds: int = 5, size: int = 64, scale: int = 256, seed: int = 2, pivots: int = 24, sample: int = 2048, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` for every
    row whose vector has ``size`` components, none null or not finite.

    Centroids start as the vectors with the smallest sha256 of ``seed:id``, are moved ``rounds`` times to the rounded-down
    mean of their vectors (one without vectors stays), and vectors are assigned once more. The ``sample`` vectors with
    the smallest of these hashes yield the pivots, which change what is computed, never the result. Rows without an id
    are assigned, but start no centroid; where ids repeat, each row counts, and the smaller vector starts first; fewer
    vectors than clusters give fewer centroids; without any there are no rows. Other columns are not looked at.
    """
    kind = vectors.schema[id_column].dataType.simpleString()
    rows = usable(vectors, size, scale, id_column, vector_column)
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    # At most ``sample`` vectors, whatever the table holds.
    first = rows.filter("id IS NOT NULL").orderBy(mark, "vector").limit(sample).collect()
    found = np.array([x["vector"] for x in first], np.int64).reshape(len(first), size)
    if not len(found):
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids, fixed = found[:clusters], spread_pivots(found, pivots)

    def measure(batches):
        for batch in batches:
            lists = column_of(batch, "vector")
            body = np.asarray(lists.flatten(), np.int64).reshape(-1, size)
            table = np.sqrt(distances(body, fixed).astype(np.float64))
            yield pa.record_batch(
                [column_of(batch, "id"), pa.array([x.tobytes() for x in body], pa.binary()), pa.array([x.tobytes() for x in table], pa.binary())],
                ["id", "body", "table"])

    stored = saved(rows.mapInArrow(measure, f"id {kind}, body binary, table binary"))

    def of(batch, at: np.ndarray):
        body = _matrix(column_of(batch, "body"), size, np.int64)
        return body, *nearest(body, _matrix(column_of(batch, "table"), len(fixed), np.float64), at, fixed)

    def summed(at: np.ndarray):
        """One row a partition and centroid: the sum of its vectors and their number."""
        def run(batches):
            sums, counts = np.zeros((len(at), size), np.int64), np.zeros(len(at), np.int64)
            for batch in batches:
                body, where, _, _ = of(batch, at)
                np.add.at(sums, where, body)
                counts += np.bincount(where, minlength=len(at))
            used = np.flatnonzero(counts)
            yield pa.record_batch([pa.array(used.astype(np.int32)), pa.array(list(sums[used]), pa.list_(pa.int64())), pa.array(counts[used])], ["cluster", "sums", "n"])
        return run

    def assigned(at: np.ndarray):
        def run(batches):
            for batch in batches:
                _, where, best, taken = of(batch, at)
                yield pa.record_batch([column_of(batch, "id"), pa.array(where.astype(np.int32)), pa.array(best)], ["vec_id", "cluster", "distance"])
        return run

    for _ in range(rounds):
        partial = stored.mapInArrow(summed(centroids), "cluster int, sums array<long>, n long")
        whole = partial.groupBy("cluster").agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(size)], F.sum("n").alias("n"))
        moved = centroids.copy()
        for row in whole.collect():  # one a centroid
            moved[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(size)]
        centroids = moved

    result = saved(stored.mapInArrow(assigned(centroids), f"vec_id {kind}, cluster int, distance long"))
    sums = {x["cluster"]: x["d"] for x in result.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    marks = [(c, sums.get(c, 0), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for c, x in enumerate(centroids.tolist())]
    about = vectors.sparkSession.createDataFrame(marks, "cluster int, cluster_inertia long, centroid_sha256 string")
    total = F.lit(sum(sums.values())).cast("long").alias("inertia")
    return result.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", total, "centroid_sha256")
