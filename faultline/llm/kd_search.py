"""Exact nearest vectors by inner product, with a KD-tree for each shard of vectors.

A tree splits its vectors at the median of the widest dimension and keeps a tight box for each node. No vector in a box
has a higher product with a query than the box's bound, the sum over dimensions of the better of its two sides. A query
goes through a tree best bound first and stops when no bound reaches its k-th score so far. That score is carried from
shard to shard: first each block of queries searches one shard, then all others from there.
"""

from __future__ import annotations

import heapq
import io

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faultline.llm.shared import saved

LEAF = 256


def build(ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF) -> dict[str, np.ndarray]:
    """Vectors in tree order, and per node: rows from and to, left child (the right one follows; -1 at a leaf), box, and
    the smallest id."""
    order = np.arange(len(ids))
    nodes, rows = [(0, len(ids))], {"left": []}
    at = 0
    while at < len(nodes):
        start, end = nodes[at]
        if end - start > leaf:
            part = order[start:end]
            spread = vectors[part].max(0) - vectors[part].min(0)
            middle = (end - start) // 2
            order[start:end] = part[np.argpartition(vectors[part, int(spread.argmax())], middle)]
            rows["left"].append(len(nodes))
            nodes += [(start, start + middle), (start + middle, end)]
        else:
            rows["left"].append(-1)
        at += 1
    ids, vectors = ids[order], vectors[order]
    return {
        "ids": ids, "vectors": vectors, "bounds": np.array(nodes, np.int64), "left": np.array(rows["left"], np.int64),
        "low": np.array([vectors[a:b].min(0) for a, b in nodes]), "high": np.array([vectors[a:b].max(0) for a, b in nodes]),
        "least": np.array([ids[a:b].min() for a, b in nodes])}


def _pack(arrays: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez_compressed(out, **arrays)
    return out.getvalue()


def _unpack(blob: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(blob)) as found:
        return {x: found[x] for x in found.files}


def _exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """As doubles if no product of these whole numbers can leave what doubles hold exactly; else as 64-bit integers."""
    most = [float(np.abs(x.astype(np.float64)).max(initial=0)) for x in arrays]
    fits = most[0] * max(most[1:]) * max(1, arrays[0].shape[1]) < 2**53
    return [x.astype(np.float64) if fits else x for x in arrays]


def search(tree: dict[str, np.ndarray], queries: dict[str, np.ndarray], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the best ids and scores of this tree that may be among its best ``k``, given the score and id of
    its k-th so far (``score``, ``id``). The query's own id is left out."""
    vectors, low, high, q = _exact(tree["vectors"], tree["low"], tree["high"], queries["vectors"])
    limits = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    ids, left, bounds, least = tree["ids"], tree["left"].tolist(), tree["bounds"].tolist(), tree["least"].tolist()
    out = []
    for row in range(len(q)):
        own, last_score, last_id = queries["ids"][row], queries["score"][row], queries["id"][row]
        top = limits[row].tolist()
        best_s, best_i = np.zeros(0, vectors.dtype), np.zeros(0, np.int64)
        heap = [(-top[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < last_score:
                break
            if -bound == last_score and least[node] > last_id:
                continue
            if left[node] >= 0:
                for child in (left[node], left[node] + 1):
                    if top[child] >= last_score:
                        heapq.heappush(heap, (-top[child], child))
                continue
            a, b = bounds[node]
            scores = vectors[a:b] @ q[row]
            good = np.flatnonzero((scores >= last_score) & (ids[a:b] != own))
            if not len(good):
                continue
            best_s, best_i = np.concatenate([best_s, scores[good]]), np.concatenate([best_i, ids[a:b][good]])
            if len(best_s) >= k:
                order = np.lexsort((best_i, -best_s))[:k]
                best_s, best_i = best_s[order], best_i[order]
                if (best_s[-1], -best_i[-1]) > (last_score, -last_id):
                    last_score, last_id = best_s[-1], best_i[-1]
        keep = (best_s > last_score) | ((best_s == last_score) & (best_i <= last_id))
        out.append((best_i[keep], best_s[keep].astype(np.int64)))
    return out


def whole_numbers(vectors: DataFrame, scale: int, id_column: str, vector_column: str) -> DataFrame:
    """``id`` and ``vector``, each component x as floor(scale * x); rows without an id, or with a vector that is null,
    empty or holds a null or no finite number, are left out, and rows that repeat are one."""
    finite = F.forall(vector_column, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    scaled = F.transform(vector_column, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    usable = vectors.filter(F.col(id_column).isNotNull() & F.col(vector_column).isNotNull() & (F.size(vector_column) > 0) & finite)
    return usable.select(F.col(id_column).cast("long").alias("id"), scaled.alias("vector")).distinct()


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, rows_per_shard: int = 8192, queries_per_block: int = 2048, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the ``k`` best vectors for every query row.

    ``is_query`` is over a column ``id``. A query meets all vectors of its own length but its own row; ties go to the
    smaller id; with fewer than ``k`` others it gets all. Rows left out: see ``whole_numbers``. Where one id has several
    vectors, each is a query and a candidate of its own, but not for each other. An empty table gives no rows.
    """
    base = saved(whole_numbers(vectors, scale, id_column, vector_column).withColumn("size", F.size("vector")))
    count, asked = base.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    shards, blocks = max(1, -(-count // rows_per_shard)), max(1, -(-asked // queries_per_block))

    def plant(frame: pd.DataFrame) -> pd.DataFrame:
        tree = build(frame["id"].to_numpy(np.int64), np.stack(frame["vector"].to_numpy()).astype(np.int64))
        return pd.DataFrame({"size": frame["size"].iloc[:1], "shard": frame["shard"].iloc[:1], "tree": [_pack(tree)]})

    def bundle(frame: pd.DataFrame) -> pd.DataFrame:
        queries = {"ids": frame["id"].to_numpy(np.int64), "vectors": np.stack(frame["vector"].to_numpy()).astype(np.int64)}
        return pd.DataFrame({"size": frame["size"].iloc[:1], "block": frame["block"].iloc[:1], "queries": [_pack(queries)]})

    def run(frames):
        reached: dict[tuple, tuple] = {}
        for frame in frames:
            for size, block, packed, bounds, blob in zip(frame["size"], frame["block"], frame["queries"], frame["kth"], frame["tree"]):
                queries = _unpack(packed)
                n = len(queries["ids"])
                given = np.frombuffer(bounds, np.int64).reshape(2, n) if bounds is not None else np.array([[-(2**62)] * n, [2**62] * n], np.int64)
                score, at = reached.get((size, block), (given[0], given[1]))
                better = (given[0] > score) | ((given[0] == score) & (given[1] < at))
                queries["score"], queries["id"] = np.where(better, given[0], score), np.where(better, given[1], at)
                found = search(_unpack(blob), queries, k)
                for row, (ids, scores) in enumerate(found):
                    if len(ids) == k:
                        queries["score"][row], queries["id"][row] = scores.min(), ids[scores == scores.min()].max()
                reached[size, block] = queries["score"], queries["id"]
                lengths = [len(ids) for ids, _ in found]
                yield pd.DataFrame({
                    "size": size, "block": block, "place": np.repeat(np.arange(n), lengths), "query_id": np.repeat(queries["ids"], lengths),
                    "vec_id": np.concatenate([x for x, _ in found]), "score": np.concatenate([x for _, x in found])})

    trees = saved(base.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")).groupBy("size", "shard").applyInPandas(plant, "size int, shard int, tree binary"))
    asking = base.filter(is_query).withColumn("block", F.pmod(F.xxhash64("id", "size"), F.lit(blocks)).cast("int"))
    asking = saved(asking.groupBy("size", "block").applyInPandas(bundle, "size int, block int, queries binary"))
    pairs = asking.join(trees, "size").withColumn("home", F.col("shard") == F.col("block") % shards)
    schema = "size int, block int, place int, query_id long, vec_id long, score long"
    first = saved(pairs.filter("home").withColumn("kth", F.lit(None).cast("binary")).select("size", "block", "queries", "kth", "tree").mapInPandas(run, schema))

    def kth(frame: pd.DataFrame) -> pd.DataFrame:
        n = int(frame["n"].iloc[0])
        bounds = np.array([[-(2**62)] * n, [2**62] * n], np.int64)
        frame = frame.dropna(subset=["place"]).sort_values(["place", "score", "vec_id"], ascending=[True, False, True])
        last = frame[frame.groupby("place").cumcount() == k - 1]
        places = last["place"].to_numpy(np.int64)
        bounds[0, places], bounds[1, places] = last["score"], last["vec_id"]
        return pd.DataFrame({"size": frame["size"].iloc[:1], "block": frame["block"].iloc[:1], "kth": [bounds.tobytes()]}) if len(frame) else pd.DataFrame({"size": [], "block": [], "kth": []})

    sizes = base.filter(is_query).withColumn("block", F.pmod(F.xxhash64("id", "size"), F.lit(blocks)).cast("int")).groupBy("size", "block").agg(F.count("*").alias("n"))
    bounds = first.join(sizes, ["size", "block"]).groupBy("size", "block").applyInPandas(kth, "size int, block int, kth binary")
    rest = pairs.filter("not home").join(bounds, ["size", "block"], "left").select("size", "block", "queries", "kth", "tree")
    rest = rest.repartition(max(1, min(shards * blocks, 4 * shards))).mapInPandas(run, schema)
    order = Window.partitionBy("query_id", "size", "block", "place").orderBy(F.desc("score"), "vec_id")
    ranked = first.unionByName(rest).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
