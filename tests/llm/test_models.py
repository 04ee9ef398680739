import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.llm import kd_search, language_id, language_model, toxicity
from faultline.llm.elias_fano import EliasFano
from faultline.llm.shared import remainder

LANGUAGES = {"aa": "the of and with from that this", "bb": "der die und nicht schön straße", "cc": "les été où ça garçon que"}


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    rows = []
    for i in range(600):
        lang = rng.choice(sorted(LANGUAGES))
        words = LANGUAGES[lang].split()
        text = " ".join(rng.choice(words) + rng.choice(["", rng.choice(words)]) for _ in range(rng.randint(3, 150)))
        rows.append((i, text, lang))
    rows += [(600, None, "aa"), (601, "", None), (602, "12 !!", "bb"), (603, "und nicht " * 20000, None), (None, "der die und nicht", "bb"), (5, rows[5][1], rows[5][2])]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash")).withColumn("label", F.lit("clash"))


def test_language_id(labelled, none):
    held_out = remainder("doc_id", 4) == 2
    model = language_id.fit(labelled, ~held_out, sample_per_language=60)
    assert model.languages == sorted(LANGUAGES)
    rows = language_id.predict(labelled, model).withColumn("held_out", held_out).collect()
    assert len(rows) == labelled.count()
    test = [r for r in rows if r.held_out and r.lang and r.doc_id is not None and r.doc_id < 600]
    assert sum(r.lang_pred == r.lang for r in test) > 0.97 * len(test) > 90
    by_id = {r.doc_id: r for r in rows}
    assert [(by_id[i].lang_pred, by_id[i].score) for i in (600, 601, 602)] == [("und", 0.0)] * 3
    assert by_id[603].lang_pred == "bb" and all(0 <= r.score <= 1 for r in rows)
    assert language_id.predict(none, model).collect() == []
    assert language_id.fit(none, F.lit(True)) is None
    nothing = language_id.predict(labelled, None, ["doc_id"]).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}


def test_toxicity(spark, none):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgilmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(600)]
    rows, labels = [], []
    for i in range(900):
        text = [rng.choice(words) for _ in range(rng.randint(2, 200))]
        toxic = i % 3 == 0
        if toxic:
            for _ in range(rng.randint(1, 3)):
                text[rng.randrange(len(text))] = rng.choice(["idiot", "worthless", "scumbag"])
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    rows += [(900, None), (901, ""), (902, "!!"), (None, "fine"), (3, rows[3][1]), (903, "such a worthles1 idiott"), (904, " ".join(words * 60) + " idiot")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("label", F.lit("clash"))
    truth = spark.createDataFrame([*labels, (3, 1), (2000, 1), (None, 0), (17, None)], "doc_id long, toxic int")
    held_out = remainder("doc_id", 5) == 0
    model = toxicity.fit(docs, truth, ~held_out, sample_per_class=250)
    found = toxicity.score(docs, model).withColumn("held_out", held_out).collect()
    assert len(found) == len(rows)
    test = [(r.score >= 0.5, r.doc_id % 3 == 0) for r in found if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert sum(a == b for a, b in test) > 0.95 * len(test) > 100
    score = {r.doc_id: r.score for r in found}
    assert score[900] == score[901] == score[902] < 0.5 < score[903] and score[904] > 0.5
    assert all(0 <= x <= 1 for x in score.values())
    assert toxicity.score(none, model).collect() == []
    assert toxicity.fit(docs, truth.filter("toxic = 0"), F.lit(True)) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}


def test_elias_fano():
    rng = np.random.default_rng(0)
    for n, top in ((0, 0), (1, 0), (5, 3), (1000, 100), (1000, 10**9), (20000, 40000)):
        values = np.unique(rng.integers(0, top + 1, n))
        coded = EliasFano(values)
        asked = np.concatenate([values, rng.integers(-2, top + 5, 300)])
        place = {int(x): k for k, x in enumerate(values)}
        assert coded.find(asked).tolist() == [place.get(int(x), -1) for x in asked]
        if n:
            assert (coded.at(np.arange(len(values))) == values).all()
    repeated = np.sort(rng.integers(0, 50, 400))
    assert (EliasFano(repeated).at(np.arange(400)) == repeated).all()


def test_language_model(docs, none, texts, monkeypatch):
    monkeypatch.setattr(language_model, "SHARD_TOKENS", 4000)
    monkeypatch.setattr(language_model, "BLOCK_BYTES", 40_000)
    every = [*texts, texts[3], (None, "no id here")]
    tokens = lambda x: [*(x or "").encode().lower().split(), b""]
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 5 == 1
    one, two, before = Counter(), Counter(), Counter()
    for i, x in every:
        if not held(i):
            line = [None, *tokens(x)]
            one.update(line[1:])
            two.update(zip(line, line[1:]))
            before.update(line[:-1])
    n, kinds, mix = sum(one.values()), len(one), language_model.MIX
    p1 = lambda w: (one[w] + 0.5) / (n + 0.5 * (kinds + 1))
    p2 = lambda v, w: (1 - mix) * two[v, w] / before[v] + mix * p1(w) if before[v] else p1(w)
    expected = {}
    for i, x in every:
        line = [None, *tokens(x)]
        base = sum(math.log10(p1(w)) for w in line[1:])
        expected[i] = (held(i), len(line) - 1, sum(one[w] > 0 for w in line[1:]), n, base, sum(math.log10(p2(*g)) for g in zip(line, line[1:])))
    rows = language_model.score(docs, remainder("doc_id", 5) == 1).collect()
    assert len(rows) == len(every)
    for r in rows:
        e = expected[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == e[:4]
        assert r.base_score == pytest.approx(e[4], rel=1e-9) and r.score == pytest.approx(e[5], abs=1.3e-4 * r.n_tokens)
    assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out)
    assert language_model.score(none, remainder("doc_id", 5) == 1).collect() == []
    untaught = language_model.score(docs, F.lit(True)).collect()
    assert {(r.train_tokens, r.n_known, r.base_score) for r in untaught} == {(0, 0, 0.0)}


def test_probabilities_after_a_context_sum_to_one_at_most(tmp_path):
    v, w, count = np.array([0, 0, 1, 1, 1]), np.array([1, 2, 0, 3, 5]), np.array([3, 1, 1, 2, 3])
    unigram, contexts = np.array([5, 4, 1, 3, 1, 2]) / 17, np.array([4, 6, 1, 0, 0, 0])
    trie = language_model.Trie(str(tmp_path), 6, v, w, count, contexts, unigram)
    for context in range(6):
        logs = trie.logs(np.full(6, context), np.arange(6), contexts, unigram)
        assert (10**logs).sum() < 1.001
        words, own = trie.successors(context)
        assert words.tolist() == w[v == context].tolist() and own == pytest.approx(logs[words])


def _nearest(rows, k):
    usable = {(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, q in usable:
        if i % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in usable if j != i and len(v) == len(q))[:k]
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(best)]
    return sorted(out)


def test_nearest(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(900)]
    rows += [(1000 + i, [0.5] * 8) for i in range(300)]  # ties
    rows += [(2000, None), (2001, []), (2002, [None] * 8), (2003, [float("nan")] * 8), (2004, [float("inf")] * 8), (None, [1.0] * 8), rows[7], (2020, [1.0, 2.0]), (2021, [3.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("clash")).withColumn("shard", F.lit(1))
    wanted = _nearest(rows, 20)
    for sizes in ({}, {"rows_per_shard": 150, "queries_per_block": 20}):
        assert sorted(map(tuple, kd_search.nearest(frame, F.col("id") % 20 == 0, **sizes).collect())) == wanted
    assert kd_search.nearest(frame.limit(0), F.col("id") % 20 == 0).collect() == []


def test_tree_search_with_leaves_of_few_and_large_numbers():
    rng = np.random.default_rng(2)
    for top in (50, 1 << 30):
        vectors = rng.integers(-top, top, (500, 6))
        tree = kd_search.build(np.arange(500), vectors, leaf=8)
        queries = {"ids": np.arange(40), "vectors": vectors[:40], "score": np.full(40, -(2**62)), "id": np.full(40, 2**62)}
        for row, (ids, scores) in enumerate(kd_search.search(tree, queries, 5)):
            every = vectors @ vectors[row]
            order = sorted((-int(s), j) for j, s in enumerate(every) if j != row)[:5]
            assert [(-int(s), int(j)) for j, s in zip(ids, scores)] == order
