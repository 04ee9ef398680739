"""Hard negatives by an inverted multi-index over the two halves of the vectors.

A codebook for each half, fitted on a bounded sample, puts every row into a cell, a pair of codes. No row of a cell has a
higher product with an anchor than the cell's bound: for each half the product with its code plus the half's length times
the code's radius. The bound is a sum of two half bounds, so a heap over the two sorted lists visits cells best first (a
multi-sequence walk) and stops when every window has its rows and no cell left can reach the last of them.

Cells lie in shards of a few thousand rows. An anchor first asks the shards of its best cells; the scores reached there say
which of the other shards it must ask. Positives are found this way, then the windows they open.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faultline.llm.exchange import squeeze, unsqueeze
from faultline.llm.shared import column_of, saved

FAR = 1 << 62
CHUNK = 256  # rows that are scored together
BLOCK = 512  # anchors in a message


def fit_codes(points: np.ndarray, codes: int, rounds: int = 8) -> np.ndarray:
    """k-means of the sample's distinct points, which are few, from points spread over their order."""
    points = np.unique(points, axis=0).astype(np.float64)
    centres = points[np.linspace(0, len(points) - 1, min(codes, len(points))).astype(int)]
    for _ in range(rounds):
        near = ((points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)).argmin(1)
        counts = np.bincount(near, minlength=len(centres))
        sums = np.stack([np.bincount(near, points[:, d], len(centres)) for d in range(points.shape[1])], 1) if points.shape[1] else centres
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def nearest_codes(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest code of each point, and how far it is."""
    points = points.astype(np.float64)
    near = (-2 * points @ centres.T + (centres**2).sum(1)).argmin(1)
    return near, np.sqrt(((points - centres[near]) ** 2).sum(1))


def half_bounds(queries: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Upper and lower bounds of each query's product with the rows of each code, wider than doubles can be off."""
    queries = queries.astype(np.float64)
    middle, reach = queries @ centres.T, np.sqrt((queries**2).sum(1))[:, None] * radii
    slack = 1e-9 * (np.abs(middle) + reach) + 1e-3
    return middle + reach + slack, middle - reach - slack


def by_bound(one: np.ndarray, two: np.ndarray):
    """Pairs of places (i, j) and ``one[i] + two[j]``, from the highest sum down."""
    first, second = (-one).argsort(kind="stable"), (-two).argsort(kind="stable")
    a, b = one[first].tolist(), two[second].tolist()
    first, second = first.tolist(), second.tolist()
    heap = [(-(a[0] + b[0]), 0, 0)]
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield first[i], second[j], -bound
        if j + 1 < len(b):
            heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))


def _scores(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact products; in doubles where all their sums are exact there."""
    if rows.dtype.itemsize <= 2 and len(query) * 2.0**30 < 2**53:
        return (rows.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    return rows.astype(np.int64) @ query.astype(np.int64)


class Shard:
    """Rows in order of their cells, with the codes and radii of this shard alone."""

    def __init__(self, ids, labels, vectors, cells, far_one, far_two, books):
        order = cells.argsort(kind="stable")
        self.ids, self.labels, self.vectors, cells = ids[order], labels[order], vectors[order], cells[order]
        codes = len(books[1])
        found, starts = np.unique(cells, return_index=True)
        ends = np.append(starts[1:], len(cells))
        one, two = found // codes, found % codes
        self.ones, place_one = np.unique(one, return_inverse=True)
        self.twos, place_two = np.unique(two, return_inverse=True)
        self.rows = {(i, j): (a, b) for i, j, a, b in zip(place_one.tolist(), place_two.tolist(), starts.tolist(), ends.tolist())}
        radii = np.zeros(len(self.ones)), np.zeros(len(self.twos))
        np.maximum.at(radii[0], np.repeat(place_one, ends - starts), far_one[order])
        np.maximum.at(radii[1], np.repeat(place_two, ends - starts), far_two[order])
        self.halves = [(books[0][self.ones], radii[0]), (books[1][self.twos], radii[1])]

    def search(self, ids, labels, queries, lows, highs, floors, same: bool, k: int):
        """For each query and window the best ``k`` rows of this shard with a score in the window, not below its floor:
        (query's place, window, ids, scores)."""
        half = self.halves[0][0].shape[1]
        up_one, low_one = half_bounds(queries[:, :half], *self.halves[0])
        up_two, low_two = half_bounds(queries[:, half:], *self.halves[1])
        for at in range(len(ids)):
            windows = [w for w in range(lows.shape[1]) if lows[at, w] <= highs[at, w]]
            if not windows:
                continue
            least = {w: int(max(lows[at, w], floors[at, w])) for w in windows}
            most = int(highs[at, windows].max())
            best = {w: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for w in windows}
            waiting, held = [], 0

            def settle():
                rows = np.concatenate([np.arange(a, b) for a, b in waiting])
                scores = _scores(self.vectors[rows], queries[at])
                fits = ((self.labels[rows] == labels[at]) == same) & (self.ids[rows] != ids[at])
                for w in windows:
                    good = np.flatnonzero(fits & (scores >= least[w]) & (scores <= highs[at, w]))
                    if len(good):
                        names, points = np.concatenate([best[w][0], self.ids[rows[good]]]), np.concatenate([best[w][1], scores[good]])
                        order = np.lexsort((names, -points))[:k]
                        best[w] = names[order], points[order]
                        if len(order) == k:
                            least[w] = max(least[w], int(points[order[-1]]))

            for i, j, bound in by_bound(up_one[at], up_two[at]):
                if bound < min(least.values()):
                    break
                cell = self.rows.get((i, j))
                if cell is None or low_one[at, i] + low_two[at, j] > most:
                    continue
                waiting.append(cell)
                held += cell[1] - cell[0]
                if held >= CHUNK:
                    settle()
                    waiting, held = [], 0
            if waiting:
                settle()
            for w in windows:
                if len(best[w][0]):
                    yield at, w, *best[w]


def _laid_out(cells: pd.DataFrame, rows_per_shard: int) -> pd.DataFrame:
    """Cells with their first shard and number of shards: neighbours share one, a cell of more rows gets several."""
    first, parts, shard, filled = [], [], 0, 0
    for n in cells["n"]:
        if filled and filled + n > rows_per_shard:
            shard, filled = shard + 1, 0
        first.append(shard)
        parts.append(max(1, -(-n // rows_per_shard)))
        filled += n
        if parts[-1] > 1:
            shard, filled = shard + parts[-1], 0
    return cells.assign(first=first, parts=parts)


class Index:
    """The rows in shards, and what an anchor needs to know to find its shards: codebooks, radii and occupied cells."""

    def __init__(self, coded: DataFrame, books: list[np.ndarray], width: int, kind: np.dtype, rows_per_shard: int):
        codes = len(books[1])
        # One row a cell, so at most the square of the number of codes.
        found = coded.groupBy("cell").agg(F.count("*").alias("n"), F.max("far_one").alias("one"), F.max("far_two").alias("two")).collect()
        cells = _laid_out(pd.DataFrame([x.asDict() for x in found]).sort_values("cell"), rows_per_shard)
        self.books, self.width, self.kind = books, width, kind
        self.one, self.two = (cells["cell"] // codes).to_numpy(), (cells["cell"] % codes).to_numpy()
        self.first, self.parts, self.counts = (cells[x].to_numpy() for x in ("first", "parts", "n"))
        self.radii = [np.zeros(len(x)) for x in books]
        np.maximum.at(self.radii[0], self.one, cells["one"].to_numpy())
        np.maximum.at(self.radii[1], self.two, cells["two"].to_numpy())
        self.shards = int((self.first + self.parts).max())
        spark = coded.sparkSession
        places = F.broadcast(spark.createDataFrame(cells[["cell", "first", "parts"]].astype(int).values.tolist(), "cell int, first int, parts int"))

        def pack(frame: pd.DataFrame) -> pd.DataFrame:
            vectors = np.frombuffer(b"".join(frame["body"]), kind)
            blob = squeeze(*(frame[x].to_numpy(t) for x, t in (("id", np.int64), ("label", np.int64))), vectors, frame["cell"].to_numpy(np.int64), frame["far_one"].to_numpy(), frame["far_two"].to_numpy())
            return pd.DataFrame({"shard": frame["shard"].iloc[:1], "part": 0, "body": [blob]})

        placed = coded.join(places, "cell").withColumn("shard", (F.col("first") + F.pmod(F.xxhash64("row"), "parts")).cast("int"))
        self.packed = saved(placed.groupBy("shard").applyInPandas(pack, "shard int, part int, body binary"))
        self.tasks = max(spark.sparkContext.defaultParallelism, min(self.shards, 4096))

    def asked(self, queries, rows, lows, highs, floors, home: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a query's place and a shard: those whose cells may hold a row for a window, or, with ``home``, those
        of its best cells that may, up to that many rows."""
        half = self.books[0].shape[1]
        up_one, low_one = half_bounds(queries[:, :half], self.books[0], self.radii[0])
        up_two, low_two = half_bounds(queries[:, half:], self.books[1], self.radii[1])
        real = lows <= highs
        least = np.where(real, np.maximum(lows, floors), FAR).min(1)
        most = np.where(real, highs, -FAR).max(1)
        up, low = up_one[:, self.one] + up_two[:, self.two], low_one[:, self.one] + low_two[:, self.two]
        fit = (up >= least[:, None]) & (low <= most[:, None])
        if home is None:
            place, cell = np.nonzero(fit)
            parts = self.parts[cell]
            start = np.repeat(np.cumsum(parts) - parts, parts)
            shards = np.repeat(self.first[cell], parts) + np.arange(parts.sum()) - start
            pairs = np.unique(np.stack([np.repeat(place, parts), shards]), axis=1)
            return pairs[0], pairs[1]
        at = {cell: n for n, cell in enumerate(zip(self.one.tolist(), self.two.tolist()))}
        found = set()
        for place in np.flatnonzero(fit.any(1)).tolist():
            held = 0
            for i, j, bound in by_bound(up_one[place], up_two[place]):
                if held >= home or bound < least[place]:
                    break
                cell = at.get((i, j))
                if cell is not None and fit[place, cell]:
                    # One part of a large cell is enough for a start.
                    found.add((place, int(self.first[cell] + rows[place] % self.parts[cell])))
                    held += self.counts[cell]
        pairs = np.array(sorted(found), np.int64).reshape(-1, 2).T
        return pairs[0], pairs[1]

    def ask(self, asks: DataFrame, same: bool, k: int, windows: int, home: int | None) -> DataFrame:
        """``row``, ``window``, ``found``, ``score`` and ``rank``: the best ``k`` for each anchor and window so far.

        ``asks`` has ``row, id, label, body`` and arrays ``lows, highs, floors`` of ``windows`` numbers. Shards and
        messages meet in one stream sorted by shard, each shard's rows first, so a task holds one shard at a time.
        """
        kind, width, books, index = self.kind, self.width, self.books, self._router()

        def send(batches):
            for batch in batches:
                for start in range(0, batch.num_rows, BLOCK):
                    part = batch.slice(start, BLOCK)
                    n = part.num_rows
                    row, name, label = (np.asarray(column_of(part, x).to_pylist(), np.int64) for x in ("row", "id", "label"))
                    queries = np.frombuffer(b"".join(column_of(part, "body").to_pylist()), kind).reshape(n, width)
                    lows, highs, floors = (np.asarray(column_of(part, x).to_pylist(), np.int64).reshape(n, windows) for x in ("lows", "highs", "floors"))
                    place, shard = index.asked(queries, row, lows, highs, floors, home)
                    order = shard.argsort(kind="stable")
                    place, shard = place[order], shard[order]
                    goals, starts = np.unique(shard, return_index=True)
                    for goal, chosen in zip(goals.tolist(), np.split(place, starts[1:])):
                        body = squeeze(row[chosen], name[chosen], label[chosen], queries[chosen].ravel(), *(x[chosen].ravel() for x in (lows, highs, floors)))
                        yield pa.record_batch([pa.array([goal], pa.int32()), pa.array([1], pa.int32()), pa.array([body], pa.binary())], ["shard", "part", "body"])

        def answer(batches):
            number, shard = None, None
            for batch in batches:
                for goal, part, body in zip(*(column_of(batch, x) for x in ("shard", "part", "body"))):
                    goal, body = goal.as_py(), unsqueeze(body.as_py())
                    if part.as_py() == 0:
                        ids, labels, vectors, *rest = body
                        number, shard = goal, Shard(ids, labels, vectors.reshape(len(ids), width), *rest, books)
                        continue
                    if number != goal:
                        continue  # no row fell into this part of a split cell
                    row, name, label, queries, *limits = body
                    n = len(row)
                    found = list(shard.search(name, label, queries.reshape(n, width), *(x.reshape(n, windows) for x in limits), same, k))
                    if found:
                        sizes = [len(x[2]) for x in found]
                        yield pa.record_batch([
                            pa.array(np.repeat(row[[x[0] for x in found]], sizes)), pa.array(np.repeat([x[1] for x in found], sizes).astype(np.int32)),
                            pa.array(np.concatenate([x[2] for x in found])), pa.array(np.concatenate([x[3] for x in found]))], ["row", "window", "found", "score"])

        sent = asks.select("row", "id", "label", "body", "lows", "highs", "floors").mapInArrow(send, "shard int, part int, body binary")
        stream = self.packed.unionByName(sent).repartition(self.tasks, "shard").sortWithinPartitions("shard", "part")
        replies = stream.mapInArrow(answer, "row long, window int, found long, score long")
        order = Window.partitionBy("row", "window").orderBy(F.desc("score"), "found")
        return saved(replies.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k))

    def _router(self) -> "Index":
        """A copy without data frames, to travel to the tasks."""
        out = object.__new__(Index)
        out.__dict__ = {k: v for k, v in self.__dict__.items() if k != "packed"}
        return out

    def best(self, asks: DataFrame, same: bool, k: int, windows: int, home: int) -> DataFrame:
        """As ``ask``, exact: a first round sets floors, a second asks all shards that may hold more."""
        start = self.ask(asks, same, k, windows, home)
        last = start.filter(F.col("rank") == k).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("last"))
        floors = F.transform("floors", lambda x, w: F.greatest(x, F.coalesce(F.try_element_at("last", w), x)))
        return self.ask(asks.join(last, "row", "left").withColumn("floors", floors), same, k, windows, None)


def _rows(vectors: DataFrame, label: Column | None, scale: int, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """``id``, ``label`` and ``vector`` (floor(scale * x)) of the rows that take part; rows that repeat are one."""
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("long").alias("label"), F.col(vector_column).alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull())
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    scaled = F.transform("vector", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    rows = rows.filter(finite).withColumn("vector", scaled)
    return (rows if label is None else rows.withColumn("label", label.cast("long"))).distinct()


def mine(
    vectors: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    scale: int = 256, codes: int = 32, sample: int = 4096, rows_per_shard: int = 2048, home: int = 2048,
    id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``.

    ``is_anchor`` and ``label`` (in place of the column's) are over columns ``id`` and ``label``. An anchor's positives are
    the ``positives`` other rows of its label with the highest scores; for each, the first ``negatives`` rows of other
    labels with a score of ``low`` to ``high`` percent of the positive's; ties go to the smaller id. All, if there are fewer.

    Rows with a null id, label or vector, or a component that is null or not finite, take no part; rows that repeat are
    one; rows of one id are never each other's positive or negative, and each is an anchor of its own; a shorter vector
    counts as if zeros followed; other columns are not looked at; an empty table gives no rows. Numbers so large that
    scores leave 64 bits raise. Only the ``codes`` are fitted on a sample, of ``sample`` rows; the result is exact.
    """
    spark = vectors.sparkSession
    base = saved(_rows(vectors, label, scale, id_column, vector_column, label_column).withColumn("row", F.monotonically_increasing_id()))
    width, largest = base.agg(F.max(F.size("vector")), F.max(F.array_max(F.transform("vector", F.abs)))).first()
    if width is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    width, largest = max(width, 2), max(largest or 0, 1)
    if width * largest * largest * 100 >= FAR:
        raise ValueError(f"scores of {width} components up to {largest} leave 64 bits")
    kind = next(np.dtype(x) for x in ("<i2", "<i4", "<i8") if largest <= np.iinfo(x).max)
    half = width // 2

    def matrix(lists) -> np.ndarray:
        lengths, flat = np.asarray(pc.list_value_length(lists), np.int64), np.asarray(lists.flatten(), np.int64)
        out = np.zeros((len(lengths), width), kind)
        out[np.arange(width) < lengths[:, None]] = flat
        return out

    seen = base.orderBy(F.xxhash64("id", "label", "vector")).limit(sample).select("vector").toArrow()
    seen = matrix(seen.column("vector").combine_chunks())
    books = [fit_codes(seen[:, :half], codes), fit_codes(seen[:, half:], codes)]
    second = len(books[1])

    def encode(batches):
        for batch in batches:
            body = matrix(column_of(batch, "vector"))
            one, far_one = nearest_codes(body[:, :half], books[0])
            two, far_two = nearest_codes(body[:, half:], books[1])
            yield pa.record_batch(
                [*(column_of(batch, x) for x in ("row", "id", "label")), pa.array([x.tobytes() for x in body], pa.binary()),
                 pa.array((one * second + two).astype(np.int32)), pa.array(far_one), pa.array(far_two)],
                ["row", "id", "label", "body", "cell", "far_one", "far_two"])

    coded = saved(base.mapInArrow(encode, "row long, id long, label long, body binary, cell int, far_one double, far_two double"))
    index = Index(coded, books, width, kind, rows_per_shard)
    anchors = coded.filter(is_anchor).select("row", "id", "label", "body")
    number = lambda x, n: F.array_repeat(F.lit(x).cast("long"), n)
    asks = anchors.withColumns({"lows": number(-FAR, 1), "highs": number(FAR, 1), "floors": number(-FAR, 1)})
    near = index.best(asks, True, positives, 1, home).drop("window")

    # A negative score leaves no room between its percentages.
    whole = lambda x: ((x - x % 100) / 100).cast("long")
    points = F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"])
    opened = near.groupBy("row").agg(points.alias("points"))
    padded = lambda f, gap: F.transform(
        F.sequence(F.lit(1), F.lit(positives)), lambda p: F.coalesce(F.when(F.try_element_at("points", p) >= 0, f(F.try_element_at("points", p))), F.lit(gap).cast("long")))
    asks = anchors.join(opened, "row").withColumns({
        "lows": padded(lambda s: whole(s * low + 99), 1),
        "highs": padded(lambda s: whole(s * high), 0), "floors": number(-FAR, positives)})
    far = index.best(asks.drop("points"), False, negatives, positives, home)
    known = near.select("row", (F.col("rank") - 1).alias("window"), F.col("found").alias("positive_id"), F.col("score").alias("positive_score"))
    out = far.join(known, ["row", "window"]).join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
    return out.select("anchor_id", "positive_id", "rank", F.col("found").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
