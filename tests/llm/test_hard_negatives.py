import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.llm import hard_negatives


def _mined(rows, scale=256):
    usable = {(i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(scale * x) for x in v))
              for i, v, label in rows if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, label, q in usable:
        if i % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j, other) for j, other, v in usable if j != i)
            for s, j, _ in [x for x in scored if x[2] == label][:5]:
                fits = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
                out += [(i, j, n + 1, x[1], -s, -x[0]) for n, x in enumerate(fits)]
    return sorted(out)


def moved():
    return F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    centres = [[rng.gauss(0, 1) for _ in range(7)] for _ in range(6)]
    out = [(i, [c + rng.gauss(0, 0.6) for c in rng.choice(centres)], rng.randrange(10)) for i in range(1500)]
    out += [(2000 + i, [0.5] * 7, i % 3) for i in range(400)]  # ties, and one cell with many rows
    out += [(3000, None, 1), (3100, [None] * 7, 1), (3200, [float("nan")] * 7, 1), (3300, [float("inf")] * 7, 1), (3400, [1.0] * 7, None), (None, [1.0] * 7, 1)]
    return out + [out[100], out[100], (200, [0.1] * 7, 4), (3500, [1.0, 2.0], 1), (3501, [2.0], 1), (3502, [3.0, 0.5, 0.1], 2), (3600, [], 2), (3700, [0.0] * 7, 2), (3800, [-1.0] * 7, 3)]


def test_mined_as_by_looking_at_all(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    frame = frame.withColumns({x: F.lit("clash") for x in ("id", "row", "vector", "cell", "shard", "rank")}).repartition(4)
    wanted = _mined(rows)
    for sizes in ({}, {"rows_per_shard": 60, "codes": 5, "home": 40, "sample": 100}, {"codes": 1}):
        found = sorted(map(tuple, hard_negatives.mine(frame, F.col("id") % 100 == 0, moved(), **sizes).collect()))
        assert found == wanted, sizes
    assert hard_negatives.mine(frame.limit(0), F.col("id") % 100 == 0, moved()).collect() == []
    assert hard_negatives.mine(frame, F.lit(False), moved()).collect() == []


def test_numbers_that_leave_64_bits_raise(spark):
    frame = spark.createDataFrame([(0, [1e8] * 4, 1), (1, [1e8] * 4, 2)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(ValueError, match="64 bits"):
        hard_negatives.mine(frame, F.col("id") % 100 == 0)


def test_walk_goes_down_and_meets_all():
    rng = np.random.default_rng(1)
    one, two = rng.normal(0, 1, 9), rng.normal(0, 1, 5)
    met = list(hard_negatives.by_bound(one, two))
    assert [x[2] for x in met] == sorted((a + b for a in one for b in two), reverse=True)
    assert len({x[:2] for x in met}) == 45


def test_walk_stops_early_where_cells_tell_rows_apart(monkeypatch):
    """Rows in tight groups: an anchor's shard scores a small part of them."""
    rng = np.random.default_rng(2)
    books = [rng.normal(0, 400, (16, 8)), rng.normal(0, 400, (16, 8))]
    cells = rng.integers(0, 256, 20000)
    noise = rng.normal(0, 3, (20000, 16))
    vectors = np.floor(np.concatenate([books[0][cells // 16], books[1][cells % 16]], 1) + noise).astype(np.int16)
    far = [np.sqrt(((vectors[:, a : a + 8] - book[code]) ** 2).sum(1)) for a, book, code in ((0, books[0], cells // 16), (8, books[1], cells % 16))]
    labels = rng.integers(0, 3, 20000)
    shard = hard_negatives.Shard(np.arange(20000), labels, vectors, cells, *far, books)
    scored = []
    plain = hard_negatives._scores
    monkeypatch.setattr(hard_negatives, "_scores", lambda rows, q: (scored.append(len(rows)), plain(rows, q))[1])
    limit = np.full((50, 1), hard_negatives.FAR)
    found = {at: (ids, points) for at, _, ids, points in shard.search(np.arange(50), labels[:50], vectors[:50], -limit, limit, -limit, True, 5)}
    for at in range(50):
        every = vectors.astype(np.int64) @ vectors[at].astype(np.int64)
        best = sorted((-int(s), j) for j, s in enumerate(every) if j != at and labels[j] == labels[at])[:5]
        assert [(-int(s), int(j)) for j, s in zip(*found[at])] == best
    assert sum(scored) < 0.1 * 50 * 20000


def test_cells_are_laid_out_whole_and_large_ones_split():
    import pandas as pd

    cells = hard_negatives._laid_out(pd.DataFrame({"cell": [0, 1, 2, 3, 4, 5], "n": [10, 10, 35, 5, 14, 1]}), 20)
    assert cells[["first", "parts"]].values.tolist() == [[0, 1], [0, 1], [1, 2], [3, 1], [3, 1], [3, 1]]
