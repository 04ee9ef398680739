import random
import sys
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from faultline.llm import near_copies, shared


def brute_force(texts):
    """Pairs of ids with a Jaccard similarity of 0.8 or more of their five-word shingles."""
    sets = {}
    for i, x in texts:
        words = (x or "").lower().encode().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    return {(i, j) for i, j in combinations(sorted(sets), 2) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}


def least_of(pairs, ids):
    least = {i: i for i in ids}
    while changed := [(a, b) for a, b in pairs if least[a] != least[b]]:
        for a, b in changed:
            least[a] = least[b] = min(least[a], least[b])
    return least


def test_stage_keeps_what_brute_force_keeps(spark):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(3000)]
    boiler, texts = [rng.choice(words) for _ in range(60)], []
    for k in range(60):
        body = boiler + [rng.choice(words) for _ in range(rng.choice((4, 9, 40, 200, 400)))]
        texts.append(body)
        # Changed words spread over the text: similarities on both sides of 0.8.
        for changes in (1, 2, 4, 6, 8):
            copy = list(body)
            for at in rng.sample(range(len(copy)), min(changes, len(copy) // 4)):
                copy[at] = rng.choice(words)
            texts.append(copy)
    rows = [(i, " ".join(x)) for i, x in enumerate(texts)] + [(1000, None), (1001, ""), (1002, "one two"), (1003, "One  two"), (1004, "one two three four five six")]
    pairs = brute_force(rows)
    assert len(pairs) > 100
    least = least_of(pairs, [i for i, _ in rows])
    docs = spark.createDataFrame([*rows, (None, rows[0][1]), rows[3]], "doc_id long, text string").repartition(5)
    kept = [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert sorted(kept, key=str) == sorted([i for i in [*least, 3] if least[i] == i] + [None], key=str)


def test_pairs_of_one_group(monkeypatch):
    monkeypatch.setattr(near_copies, "_STEP", 64)
    rng = np.random.default_rng(2)
    root, size = rng.integers(0, 5, 90), rng.integers(20, 60, 90)
    bits = rng.integers(0, 1 << 62, 90)
    found = {(int(a), int(b)) for x, y in near_copies.unlinked(np.arange(90), root, size, bits, *np.zeros((4, 90), np.int64)) for a, b in zip(x, y)}
    assert found == {(a, b) for a, b in combinations(range(90), 2) if root[a] != root[b] and 5 * min(size[a], size[b]) >= 4 * max(size[a], size[b])}


def test_bits_keep_pairs_of_the_least_similarity():
    """Thousands of planted pairs just above 0.8, of sets that bits judge: next to none is told apart."""
    rng = np.random.default_rng(4)
    lost = total = far = 0
    for size in (64, 120, 400, 2000):
        shared = int(np.ceil(size * 8 / 9))  # two sets of that size then have a similarity of 0.8
        for _ in range(1000 if size < 2000 else 200):
            pool = rng.integers(0, 1 << 64, 2 * size - shared, dtype=np.uint64)
            other = rng.integers(0, 1 << 64, size, dtype=np.uint64)
            x, y = near_copies._fingerprint(np.sort(pool[:size])), near_copies._fingerprint(np.sort(np.concatenate([pool[:shared], pool[size:]])))
            apart = lambda p, q: int(np.bitwise_count((p ^ q).view(np.uint64))) > near_copies.FAR_BITS
            lost, total, far = lost + apart(x, y), total + 1, far + apart(x, near_copies._fingerprint(np.sort(other)))
    assert lost <= total // 1000 and far > 0.9 * total


def test_parities_lose_no_pair_of_small_sets_and_tell_changed_texts_apart():
    rng = np.random.default_rng(6)
    apart = lambda x, y: int(np.bitwise_count((near_copies._parity(x) ^ near_copies._parity(y)).view(np.uint64)).sum()) > (len(x) + len(y)) / 9 + 1e-9
    told = 0
    for _ in range(2000):
        size = int(rng.integers(5, near_copies.SMALL - 1))
        pool = rng.integers(0, 1 << 64, 2 * size, dtype=np.uint64)
        shared = int(np.ceil(size * 8 / 9))
        x, y = pool[:size], np.concatenate([pool[:shared], pool[size : 2 * size - shared]])
        assert not apart(x, y)
        # Two texts that each differ from a third in one word of ten.
        told += apart(x, np.concatenate([pool[: size * 2 // 3], pool[size : 2 * size - size * 2 // 3]]))
    assert told > 1300


def test_a_group_of_texts_changed_too_much_gives_few_pairs(spark):
    """Copies of one text, a word in twenty changed: each like the original, none like another; its pairs are not verified."""
    rng = random.Random(8)
    words = [f"w{k}" for k in range(5000)]
    base = [rng.choice(words) for _ in range(180)]
    rows = []
    for i in range(150):
        copy = list(base)
        for at in rng.sample(range(180), 5):
            copy[at] = rng.choice(words)
        rows.append((i, " ".join(copy)))
    pairs, seen = brute_force(rows), []
    plain = near_copies._verified

    def counted(found, *rest):
        seen.append(found.count())
        return plain(found, *rest)

    near_copies._verified = counted
    try:
        kept = [r.doc_id for r in near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()]
    finally:
        near_copies._verified = plain
    least = least_of(pairs, range(150))
    assert sorted(kept) == [i for i in range(150) if least[i] == i]
    assert sum(seen) < 0.1 * 150 * 149 / 2


def test_simhash_links_what_it_finds_and_the_rest_follows(spark, monkeypatch):
    """Of texts with a word changed SimHash finds pairs; they are verified first and not looked at again."""
    rng = random.Random(9)
    words, rows = [f"w{k}" for k in range(5000)], []
    for i in range(40):
        base = [rng.choice(words) for _ in range(600)]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join([*base[:-1], rng.choice(words)]))]
    found, seen = [], []
    plain_links, plain = near_copies.links, near_copies._verified
    monkeypatch.setattr(near_copies, "links", lambda bits: found.append(bits.count()) or plain_links(bits))
    monkeypatch.setattr(near_copies, "_verified", lambda pairs, *rest: seen.append(pairs.count()) or plain(pairs, *rest))
    kept = [r.doc_id for r in near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()]
    assert sorted(kept) == list(range(0, 80, 2))
    assert len(found) == 1 and found[0] >= 40 and seen[0] >= 30 and sum(seen) == 40


def test_sets_of_pairs_meet_row_by_row(spark, monkeypatch):
    """No batch of pairs with both sets goes to Python; pairs of exactly 0.8 are links, those just below are none."""
    words = [f"w{k}" for k in range(3000)]
    texts = [" ".join(words[:304])]  # 300 shingles
    # With n shingles of the first and others of its own: similarity n / (300 + other).
    for n, other in ((240, 0), (239, 0), (280, 50), (279, 50), (300, 75), (300, 76)):
        texts.append(" ".join(words[: n + 4] + words[1000 : 1000 + other]))
    texts.append("")
    docs = spark.createDataFrame(list(enumerate(texts)), "vertex long, text string").repartition(3)
    pairs = spark.createDataFrame([*combinations(range(len(texts)), 2)], "a long, b long")
    plans, plain = [], near_copies.saved
    monkeypatch.setattr(near_copies, "saved", lambda frame: plans.append(frame._jdf.queryExecution().optimizedPlan().toString()) or plain(frame))
    found = {tuple(x) for x in near_copies._verified(pairs, docs, 0.8).collect()}
    assert found == brute_force(enumerate(texts)) and (0, 1) in found and (0, 2) not in found
    assert "MapInArrow" in plans[-1] and "MapInArrow" not in plans[-1][: plans[-1].index("Join")]


def test_a_set_goes_once_to_a_cell_and_not_once_to_each_pair(spark, monkeypatch):
    """The larger a group of copies that are not linked, the fewer sets move for a pair."""
    rng = random.Random(10)
    words = [f"w{k}" for k in range(5000)]
    base, rows = [rng.choice(words) for _ in range(390)], []
    for i in range(120):
        copy = list(base)
        # Changed words spread over the text: the first half is linked, the others resemble many texts and none enough.
        for at in rng.sample(range(390), 2 if i < 60 else 7):
            copy[at] = rng.choice(words)
        rows.append((i, " ".join(copy)))
    seen, plain = [], near_copies._verified
    monkeypatch.setattr(near_copies, "_verified", lambda pairs, *rest: seen.append(pairs) or plain(pairs, *rest))
    kept = [r.doc_id for r in near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()]
    least = least_of(brute_force(rows), range(120))
    assert sorted(kept) == [i for i in range(120) if least[i] == i]
    pairs = seen[-1].collect()
    assert len(pairs) > 200 and len({(r.a, r.b) for r in pairs}) == len(pairs)
    moved = {(r.cell, v) for r in pairs for v in (r.a, r.b)}
    assert len(moved) < len(pairs) / 3


def test_cells_of_a_large_group_are_bounded(monkeypatch):
    monkeypatch.setattr(near_copies, "CELL", 1 << 14)
    rng = np.random.default_rng(3)
    vertex, size = rng.integers(-(1 << 62), 1 << 62, 500), rng.integers(300, 400, 500)
    a, b = (vertex[x] for x in np.triu_indices(500, 1))
    cells = near_copies._cells(a, b, vertex, size)
    weight = dict(zip(vertex.tolist(), size.tolist()))
    held = {}
    for x, y, cell in zip(a.tolist(), b.tolist(), cells.tolist()):
        held.setdefault(cell, set()).update((x, y))
    assert 100 < len(held) < 1000 and max(sum(weight[v] for v in x) for x in held.values()) < 4 * near_copies.CELL
    assert (near_copies._cells(b, a, vertex[::-1], size) == cells).all()


def test_a_pair_comes_from_the_least_shingle_it_shares():
    """Groups of six shingles: each pair is made by one of the groups that hold both its texts, as far as three shingles tell."""
    rng = np.random.default_rng(5)
    shared = [np.sort(rng.choice(6, rng.integers(1, 7), replace=False)) for _ in range(40)]
    low = [np.array([x[min(k, len(x) - 1)] for x in shared]) for k in range(near_copies.LOW)]
    made, plain = [], 0
    for shingle in range(6):
        at = np.array([k for k, x in enumerate(shared) if shingle in x])
        group = (at, at, np.full(len(at), 50), np.zeros(len(at), np.int64), *np.zeros((8, len(at)), np.int64))
        plain += len(at) * (len(at) - 1) // 2
        for x, y in near_copies.unlinked(*group, other=tuple(z[at] for z in low), shingle=shingle):
            made += zip(x.tolist(), y.tolist())
    assert set(made) == {(i, j) for i, j in combinations(range(40), 2) if set(shared[i]) & set(shared[j])}
    assert len(made) < 1.2 * len(set(made)) < 0.8 * plain


def test_wide_bits_keep_similar_large_sets_and_tell_others_apart():
    rng = np.random.default_rng(7)
    apart = lambda x, y: int(np.bitwise_count((x ^ y).view(np.uint64)).sum()) > near_copies.FAR_WIDE
    wide = lambda found: near_copies._wide(near_copies._mixed(np.sort(found)))
    for size in (near_copies.WIDE_FROM, 1500):
        told = 0
        for _ in range(300):
            shared, fifth = int(np.ceil(size * 8 / 9)), size // 5
            pool = rng.integers(0, 1 << 64, 2 * size, dtype=np.uint64)
            first = wide(pool[:size])
            assert not apart(first, wide(np.concatenate([pool[:shared], pool[size : 2 * size - shared]])))
            told += apart(first, wide(np.concatenate([pool[:fifth], pool[size : 2 * size - fifth]])))
        assert told > 290
    assert not wide(rng.integers(0, 1 << 64, near_copies.WIDE_FROM - 1, dtype=np.uint64)).any()


def test_pairs_of_long_texts_that_share_a_phrase_are_not_verified(spark, monkeypatch):
    """Long texts with one phrase in common: 64 bits leave some of their pairs, wide ones none."""
    rng = random.Random(11)
    words = [f"w{k}" for k in range(5000)]
    phrase = " ".join(rng.choice(words) for _ in range(60))
    rows = [(i, phrase + " " + " ".join(rng.choice(words) for _ in range(400))) for i in range(150)]
    seen, plain = [], near_copies._verified
    monkeypatch.setattr(near_copies, "_verified", lambda pairs, *rest: seen.append(pairs.count()) or plain(pairs, *rest))
    assert near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).count() == 150
    assert sum(seen) == 0


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
def test_a_task_leaves_no_freed_memory_in_its_worker():
    resident = lambda: int(Path("/proc/self/statm").read_text().split()[1]) * 4096 >> 20
    pinned = []

    def run(batches):
        held = [bytes(range(250)) * 200 for _ in range(4000)]
        pinned.append(bytes(range(250)) * 200)  # above what is freed, as what a worker remembers
        yield len(held)

    before = resident()
    assert list(shared.tidy(run)(iter([]))) == [4000]
    assert resident() - before < 60
    # What the task before has left goes back when the next one begins.
    assert list(run(iter([]))) == [4000]
    begun = shared.tidy(lambda batches: iter([resident()]))(iter([]))
    assert next(begun) - before < 60
