import hashlib
import os
import random
import time
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from faultline.llm import components as graph
from faultline.llm import exact_dedup, exchange, packing, shared, simhash, suffix_dedup
from faultline.llm.components import components


def test_exact_duplicates(docs, none, texts):
    groups = {}
    for i, x in [*texts, texts[3], (None, "no id here")]:
        groups.setdefault(x or "", []).append(i)
    rows = exact_dedup.exact_duplicates(docs).collect()
    assert len(rows) == len(texts) + 2
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        found = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in rows if r.text_sha256 == digest]
        assert sorted(found, key=str) == sorted(((i, keep, len(ids), i == keep) for i in ids), key=str)
    assert exact_dedup.exact_duplicates(none).collect() == []
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.text or "" for r in kept.dropDuplicates(["doc_id"]).collect()) == sorted(groups)


def test_chunks_depend_on_their_text_alone():
    body = np.random.default_rng(1).integers(97, 123, 50000).astype(np.uint8)
    alone = exact_dedup.chunk_ends(exact_dedup._cut_marks(body).tolist(), 0, len(body))
    moved = np.concatenate([body[:777], body])
    marks = [x for x in exact_dedup._cut_marks(moved).tolist() if x > 777]
    assert [x - 777 for x in exact_dedup.chunk_ends(marks, 777, len(moved))] == alone
    assert max(np.diff([0, *alone])) <= exact_dedup.MAX_CHUNK and alone[-1] == len(body)
    assert exact_dedup.chunk_ends([], 5, 5) == []


def test_one_identifier_for_two_contents_is_found_and_told_apart(spark, monkeypatch):
    frame = spark.createDataFrame([(b"a", b"x"), (b"a", b"x"), (b"b", b"x"), (b"b", b"y")], "id binary, content binary")
    monkeypatch.setattr(type(frame), "mapInArrow", lambda self, *_: frame)
    found = exact_dedup.clashing_chunks(frame.withColumnRenamed("content", "text")).collect()
    assert [bytes(x.id) for x in found] == [b"b"]


def test_doubtful_recipes_are_told_apart_by_their_texts(spark, docs, texts, monkeypatch):
    plain = sorted(map(str, exact_dedup.exact_duplicates(docs).collect()))
    clash = spark.createDataFrame([(xxhash.xxh3_128_digest(texts[k][1].encode()),) for k in (0, 5)], "id binary")
    monkeypatch.setattr(exact_dedup, "clashing_chunks", lambda *_: clash)
    assert sorted(map(str, exact_dedup.exact_duplicates(docs).collect())) == plain


def _fingerprint(text, k=3):
    words = text.encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _roots(values, links):
    parent = {x: x for x in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in values}


def test_near_duplicates(docs, none, texts):
    prints = {i: _fingerprint(x or "") for i, x in [*texts, (None, "no id here")]}
    values = sorted(set(prints.values()))
    roots = _roots(values, [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 3])
    least = {}
    for i, p in prints.items():
        if i is not None:
            least[roots[p]] = min(i, least.get(roots[p], i))
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(texts) + 2
    for row in rows:
        assert row.fingerprint == f"{prints[row.doc_id]:016x}"
        assert row.component_id == least.get(roots[prints[row.doc_id]])
    assert simhash.near_duplicates(none).collect() == []
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {*least.values(), None}


def test_links_connect_what_brute_force_connects(spark):
    rng = random.Random(2)
    values = {rng.getrandbits(64) for _ in range(30)}
    for x in list(values):
        for _ in range(rng.choice((0, 3, 40))):
            for _ in range(rng.randint(1, 3)):
                x ^= 1 << rng.randrange(64)
            values.add(x)
    values = sorted(values)
    expected = _roots(values, [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 3])
    frame = spark.createDataFrame([(simhash._signed(x),) for x in values], "bits long")
    for large in (simhash.LARGE, 3):
        found = {r.vertex % (1 << 64): r.root for r in components(simhash.links(frame, large=large)).collect()}
        groups = {}
        for x in values:
            groups.setdefault(found.get(x, simhash._signed(x)), set()).add(x)
        wanted = {}
        for x in values:
            wanted.setdefault(expected[x], set()).add(x)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_a_large_group_is_searched_vertex_by_vertex():
    rng = np.random.default_rng(4)
    base = int(rng.integers(1 << 62))
    values = np.unique([base ^ sum(1 << int(k) for k in rng.integers(0, 20, rng.integers(0, 6))) for _ in range(400)])
    assert len(values) > simhash._SMALL
    a, b = simhash.group_links(np.zeros(len(values), np.int64), values)
    assert len(a) < len(values)
    near = [(int(x), int(y)) for x in values for y in values if x < y and (int(x) ^ int(y)).bit_count() <= 3]
    assert _roots(map(int, values), zip(a.tolist(), b.tolist())) == _roots(map(int, values), near)


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    found = {(r.vertex, r.root) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {(k, 0) for k in range(41)} | {(k, 100) for k in range(100, 160)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_components_in_few_shuffles_and_checkpoints(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(graph, "saved", lambda frame: rounds.append(frame._jdf.queryExecution().executedPlan().toString().count("Exchange ")) or simhash.saved(frame))
    rng = random.Random(5)
    names = sorted({rng.getrandbits(63) - (1 << 62) for _ in range(400)}, key=str)
    assert len(names) == 400
    pairs = [(names[k], names[k + 1]) for k in range(0, 400, 2)]
    assert len(components(spark.createDataFrame(pairs, "a long, b long").repartition(4)).collect()) == 400
    assert len(rounds) == 1 and rounds[0] <= 2  # the second exchange is that of the given rows
    rounds.clear()
    edges = [(rng.choice(names), rng.choice(names)) for _ in range(230)] + [(names[0], x) for x in names[:50]] + [(None, names[9]), (names[9], None)]
    # Tasks that merge a few edges at once and keep those of one vertex together give the same.
    for most in (graph._AT_ONCE, 3):
        monkeypatch.setattr(graph, "_AT_ONCE", most)
        found = components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()
        real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
        assert sorted((r.vertex, r.root) for r in found) == sorted(_roots({x for e in real for x in e}, real).items())
    assert max(rounds) <= 4


def test_what_is_saved_leaves_no_shuffle_files(spark):
    def files():
        folders = [x.toString() for x in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
        return {f for top in folders for _, _, names in os.walk(top) for f in names if f.startswith("shuffle")}

    before = files()
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    found = shared.saved(counts)
    ends = time.time() + 20  # files go in the background
    while (left := files() - before) and time.time() < ends:
        time.sleep(0.2)
    assert not left
    assert found.count() == counts.count() == 7
    assert spark.conf.get(shared.DROP_SHUFFLES) == "false"


def test_a_tokenizer_goes_when_a_task_of_another_stage_begins():
    tokens = {bytes([x]): x for x in range(256)}
    first = packing._tokenizer("a path", tokens, {})
    assert packing._tokenizer("a path", tokens, {}) is first
    assert list(shared.tidy(lambda batches: iter([len(shared.kept)]))([])) == [0]
    assert packing._tokenizer("a path", tokens, {}) is not first
    shared.kept.clear()


def _repeats(texts):
    seen = Counter(x[i : i + 200] for x in texts for i in range(len(x) - 199))
    out = []
    for x in texts:
        gone = np.zeros(len(x), bool)
        for i in range(len(x) - 199):
            if seen[x[i : i + 200]] > 1:
                gone[i : i + 200] = True
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(x) else 0
        out.append((len(x), int(gone.sum()), runs, bytes(np.frombuffer(x, np.uint8)[~gone])))
    return out


def test_repeats_are_removed(docs, none, texts, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(exchange, "BLOCK_BYTES", 30_000)
    every = [*texts, texts[3], (None, "no id here")]
    expected = Counter((i, n, gone, runs, hashlib.sha256(left).hexdigest(), None if x is None else left.decode("utf-8", "ignore")) for (i, x), (n, gone, runs, left) in zip(every, _repeats([(x or "").encode() for _, x in every])))
    rows = suffix_dedup.remove_repeats(docs, with_text=True).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.text) for r in rows) == expected
    assert sum(r.n_removed for r in rows) > 10_000
    assert suffix_dedup.remove_repeats(none).collect() == []
    kept = suffix_dedup.remove_repeats(docs, keep=docs.columns, with_text=True)
    assert set(docs.columns) <= set(kept.columns) and len(kept.columns) == len(set(kept.columns))


def test_a_frequent_line_is_sharded_by_its_strings(spark, monkeypatch):
    rng = random.Random(11)

    def noise(n):
        return "".join(rng.choice("abcdefgh ") for _ in range(n))

    line = noise(90)
    texts = [noise(150) + line + noise(150) for _ in range(60)]
    # Repeats that hold the line: cut out of other texts, within a text, and as a whole.
    texts += ["x" + t[60:340] + noise(40) for t in texts[:9]] + [texts[10] + "y" + texts[10][40:300], texts[11], texts[11]]
    bodies = [x.encode() for x in texts]
    part = suffix_dedup.Stretches(np.frombuffer(b"".join(bodies), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in bodies])]))
    digests = part.digests(np.arange(len(part.start)))
    status = exchange.unsqueeze(suffix_dedup.judge([exchange.squeeze(part.value, digests, part.repeats_within())], 10)[0][0])[0]
    assert (status & 4).any() and not (status & 6 == 6).any()
    # No minimizer of more than ten different stretches has its bytes compared in one shard.
    compared = {(int(v), int(d)) for v, d, x in zip(part.value, digests, status) if x & 2}
    assert max(Counter(v for v, _ in compared).values(), default=0) <= 10
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 10_000)
    monkeypatch.setattr(exchange, "BLOCK_BYTES", 6_000)
    expected = Counter((i, n, gone, runs, hashlib.sha256(left).hexdigest()) for i, (n, gone, runs, left) in enumerate(_repeats(bodies)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for many in (10, 1):
        monkeypatch.setattr(suffix_dedup, "MANY", many)
        rows = suffix_dedup.remove_repeats(docs).collect()
        assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == expected


def test_suffix_arrays_and_their_merge():
    rng, pick = np.random.default_rng(1), random.Random(5)
    for _ in range(15):
        parts = [rng.integers(97, 99, rng.integers(200, 420)).astype(np.uint8).tobytes() if pick.random() < 0.5 else (b"ab" * 300)[: pick.randint(200, 400)] for _ in range(6)]
        parts.append(parts[0][20:] + parts[1])
        data, offsets = np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
        array = suffix_dedup.SuffixArray(data, offsets)
        suffixes = [array.text[i : i + array.left[i]].tobytes() for i in array.order]
        assert suffixes == sorted(suffixes)
        seen = Counter(x[i : i + 200] for x in parts for i in range(len(x) - 199))
        wanted = [k < len(x) - 199 and seen[x[k : k + 200]] > 1 for x in parts for k in range(len(x))]
        for size in (1 << 20, 700):
            assert suffix_dedup.repeated_starts(np.zeros(len(parts), np.uint64), data, offsets, size).tolist() == wanted
