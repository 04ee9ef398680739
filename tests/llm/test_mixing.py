import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.llm import mixing


def _size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def _targets(sizes, weights=(3, 1, 2)):
    """By the rule as it is said: share by weight, cap, share the excess again."""
    names = sorted(sizes, key=lambda x: (x is None, x or ""))
    part = {x: weights[i % len(weights)] for i, x in enumerate(names)}
    target, left, open_ = {x: 0.0 for x in names}, 1.5 * sum(sizes.values()), set(names)
    while open_ and left > 1e-9:
        total = sum(part[x] for x in open_)
        for x in list(open_):
            target[x] += left * part[x] / total
        left = 0.0
        for x in list(open_):
            if target[x] >= 2 * sizes[x]:
                left += target[x] - 2 * sizes[x]
                target[x] = 2 * sizes[x]
                open_.remove(x)
    return target


def _taken(rows, seed=11):
    """A plain walk over each source's documents in order of their ranks."""
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + _size(text)
    target, out = _targets(sizes), []
    for source in sizes:
        copies = min(2.0, target[source] / sizes[source]) if sizes[source] else 0.0
        whole, p, listed = math.floor(copies), copies - math.floor(copies), []
        for i, text, s in rows:
            if s == source:
                body = hashlib.md5((text or "").encode()).hexdigest()
                u = (int(hashlib.md5(f"{seed}:{'' if i is None else i}:{body}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
                odds = u / (1 - u) / (p / (1 - p)) if p > 0 and _size(text) else math.inf
                listed.append((odds / (1 + odds) if odds < math.inf else 2.0, -1 if i is None else i, _size(text)))
        left = math.floor(target[source] + 0.5) - whole * sizes[source]
        for place, i, size in sorted(listed):
            more = min(left, size) if place < 2 else 0
            left -= more
            out.append((None if i == -1 else i, size, sizes[source], round(target[source], 6), whole * size + more))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(("ab", "c", "ćd", "e f")) for _ in range(n))
    out = [(i, text(rng.choice((1, 5, 40))), rng.choice(("a", "a", "a", "a", "b", "é", "z", None))) for i in range(400)]
    out += [(400, None, "a"), (401, "", "b"), (402, " \t\n\x0b\x0c\r", None), (403, text(20000), "a"), (None, "no id", "z"), (404, None, "empty")]
    return out + [out[0]] * 30 + [(7, "same id other text", "b")]


def test_mix_is_the_plain_walk(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs = docs.withColumns({x: F.lit("clash") for x in ("id", "size", "taken", "target", "level", "of", "n", "whole", "order")}).repartition(5)
    found = sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in mixing.mix(docs).collect()), key=str)
    assert found == _taken(rows)
    assert all(taken <= 2 * size for _, size, _, _, taken in found)
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted(((r.doc_id, r.taken) for r in again), key=str) == sorted(((x[0], x[4]) for x in found), key=str)
    other = mixing.mix(docs, seed=12).collect()
    assert sorted(((r.doc_id, r.taken) for r in other), key=str) != sorted(((x[0], x[4]) for x in found), key=str)
    assert mixing.mix(docs.limit(0)).collect() == []
    blank = mixing.mix(docs.filter("doc_id in (400, 404)")).collect()
    assert sorted((r.doc_id, r["size"], r.target, r.taken) for r in blank) == [(400, 0, 0.0, 0), (404, 0, 0.0, 0)]


def test_unequal_weights(spark):
    """Documents come in about as often as their weight says, whole copies are certain, the sum is fixed."""
    frame = spark.createDataFrame([(i, "w " * 10, "s", float(w)) for i in range(200) for w in [(0.5, 1.0, 2.0, 30.0)[i % 4]]] + [(200, "w", "s", None), (201, "w", "s", -1.0)], "doc_id long, text string, source string, weight double")
    counts = np.zeros(202)
    for seed in range(4):
        rows = mixing.mix(frame, share=0.8, weight_column="weight", seed=seed).collect()
        assert sum(r.taken for r in rows) == round(rows[0].target) == 1602
        for r in rows:
            counts[r.doc_id] += r.taken / max(r["size"], 1) / 4
    assert (counts[200:] == 0).all()
    assert counts[3:200:4] == pytest.approx(2)  # the limit, each time
    # 601.6 words are left for the others, by weight.
    for k, p in enumerate((0.172, 0.344, 0.688)):
        assert counts[k:200:4].mean() == pytest.approx(p, abs=0.08)


def test_words_of_bytes():
    texts = [b"", b" ", b"a", b" a b ", b"a\x0bb\x0cc", "  é".encode(), b"x" * 50, b""]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    assert mixing.word_counts(data, offsets).tolist() == [len(x.split()) for x in (b"", b"", b"a", b"a b", b"a b c", b"q q", b"x", b"")]


def test_a_source_of_most_rows_is_sorted_in_its_last_stretch_only(spark):
    frame = spark.range(20000).selectExpr("id AS doc_id", "repeat('w ', 1 + CAST(id % 7 AS INT)) AS text", "IF(id % 10 = 0, 'b', 'a') AS source")
    rows = mixing.mix(frame).groupBy(F.col("doc_id") % 10 == 0).agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    assert all(r.taken == math.floor(r.target + 0.5) for r in rows) and len(rows) == 2
