import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from faultline.llm import bpe_codec, packing, pretokens, token_counts, vocab

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SIGNS = st.text(st.one_of(st.sampled_from("ab e'strvlmd \n\t1٣é　\u0085!?’ñ漢😀"), st.characters(blacklist_categories=["Cs"])), max_size=80)


def laid_out(texts):
    raw = [x.encode() for x in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)


@settings(max_examples=200, deadline=None)
@given(st.lists(SIGNS, max_size=6))
def test_pretokens_are_the_patterns_matches(texts):
    found, at = pretokens.pieces(*laid_out(texts))
    pattern = regex.compile(public_tokenizers.PATTERN)
    assert [found[a:b] for a, b in zip(at, at[1:])] == [[x.encode() for x in pattern.findall(t)] for t in texts]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


def test_token_counts(docs, none, texts, library):
    expected = {i: (len((x or "").encode()), len(library.encode(x or "", add_special_tokens=False).ids)) for i, x in texts}
    rows = token_counts.token_counts(docs, JSON, limit=50).collect()
    assert len(rows) == len(texts) + 2
    for row in rows:
        if row.doc_id is not None:
            assert (row.n_bytes, row.n_tokens, row.over_limit) == (*expected[row.doc_id], expected[row.doc_id][1] > 50)
    assert token_counts.token_counts(none, JSON).collect() == []


def test_counter_forgets_and_stays_right(library):
    counter = token_counts.Counter(*vocab.read_json(JSON)[:2], limit=20)
    words = [f" word{k}ation" for k in range(60)]
    assert counter.counts([x.encode() for x in words]) == [len(library.encode(x).ids) for x in words]


def test_codec(docs, none, texts):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    by_id = dict(texts)
    rows = bpe_codec.round_trip(docs, RANKS, with_ids=True).collect()
    assert len(rows) == len(texts) + 2
    for row in rows:
        text = by_id.get(row.doc_id, "no id here") or ""
        ids = own.encode_ordinary(text)
        assert row.ids == ids and row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe_codec.round_trip(none, RANKS).collect() == []


def test_perfect_hash_has_one_slot_for_each_key():
    keys = [f"key {k}".encode() for k in range(5000)] + [b"", b"x" * 300]
    table = bpe_codec.PerfectHash(keys)
    assert table.lookup(keys).tolist() == list(range(len(keys)))
    assert table.lookup([b"not there"]).max() < len(keys)


def _check_packing(rows, expected):
    by_doc, by_sequence = {}, {}
    for row in rows:
        ids = expected[row.doc_id]
        assert row.doc_tokens == len(ids) and row.ids_crc32 == zlib.crc32(ids[row.start : row.start + row.length].tobytes())
        by_doc.setdefault(row.doc_id, []).append((row.start, row.length))
        by_sequence.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for pieces in by_sequence.values():
        pieces.sort()
        assert [a for a, _ in pieces] == np.cumsum([0, *(n for _, n in pieces)])[:-1].tolist()
        size = sum(n for _, n in pieces)
        assert size <= 1024 and size & (size - 1) == 0
    return by_doc


def test_packing(docs, none, texts, library):
    expected = {i: np.array([*library.encode(x or "", add_special_tokens=False).ids, 0], "<u4") for i, x in [*texts, (None, "no id here")]}
    by_doc = _check_packing(packing.pack(docs, JSON).collect(), expected)
    for doc, pieces in by_doc.items():
        times = 2 if doc == 3 else 1
        assert sum(n for _, n in pieces) == times * len(expected[doc])
        if times == 1:
            pieces.sort()
            assert [a for a, _ in pieces] == np.cumsum([0, *(n for _, n in pieces)])[:-1].tolist()
    assert packing.pack(none, JSON).collect() == []


def test_neighbours_are_those_of_all_terms(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [rng.zipf(1.3, rng.integers(1, 400)).clip(1, 900).astype(np.uint16) for _ in range(150)] + [np.arange(50, 90, dtype=np.uint16)] * 3
    at = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
    frequency = np.bincount(np.concatenate([np.unique(x) for x in texts]), minlength=901)
    mean = at[-1] / len(texts)
    idf = np.log1p((len(texts) - frequency + 0.5) / (frequency + 0.5))
    weights = np.zeros((len(texts), 901))
    for k, x in enumerate(texts):
        tf = np.bincount(x, minlength=901)
        weights[k] = idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(x) / mean))
    full = (weights > 0).astype(float) @ weights.T
    for terms in (0, 40, 2048):
        monkeypatch.setattr(packing, "DENSE_TERMS", terms)
        index = packing.Index(np.concatenate(texts), at, frequency, len(texts), mean)
        for used in (np.zeros(len(texts), bool), rng.random(len(texts)) < 0.6):
            seeds = np.flatnonzero(~used)
            for seed, scores in zip(seeds.tolist(), index.scores(seeds, used)):
                assert np.allclose(scores[~used], full[seed][~used], atol=2e-3)
                found = list(packing.neighbours(scores, used))
                assert found == sorted((d for d in seeds.tolist() if scores[d] > 0), key=lambda d: (-scores[d], d))


def test_a_seed_is_packed_with_its_neighbours():
    common = np.array([7] * 10 + [8] * 10, np.uint16)
    texts = [np.concatenate([common, np.full(300, 100 + k % 5, np.uint16)]) for k in range(15)]
    at = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
    flat = np.concatenate(texts)
    frequency = np.bincount(packing._terms(flat, at)[1], minlength=200)
    lines = packing.layout(at, packing.Index(flat, at, frequency, len(texts), len(flat) / len(texts)))
    # Three documents share their words; the fourth only fills the window up.
    assert len({doc % 5 for doc, *_ in lines[0][:3]}) == 1
    assert sorted((d, s + k) for line in lines for d, s, n in line for k in range(n)) == [(d, k) for d in range(15) for k in range(320)]


def test_equal_stretches_are_named_once(monkeypatch):
    words = [b"ab", b"", b"ab", b"abc", b"x" * 50, b"x" * 50, b"ba", b"abc", b"abd"]
    data, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum([len(x) for x in words])
    starts = ends - [len(x) for x in words]
    for prints in (bpe_codec._prints, lambda flat, starts, lengths: np.zeros(len(starts), np.uint64)):  # the second: all collide
        monkeypatch.setattr(bpe_codec, "_prints", prints)
        named, which = bpe_codec.distinct(data, starts, ends, 33)
        assert [named[k] for k in which] == words


def test_codec_forgets_and_meets_again():
    ranks = vocab.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    codec = bpe_codec.Codec(ranks, bpe_codec.PerfectHash(list(ranks)), limit=5)
    rng = np.random.default_rng(3)
    words = [bytes(rng.integers(97, 123, rng.integers(1, 30)).astype(np.uint8)) for _ in range(60)] + [b"q" * 3000]
    plain = [codec.encode([x])[0] for x in words]
    for _ in range(3):
        for at in range(0, len(words), 7):
            lines, decoded = codec.written(words[at : at + 7] * 2)
            assert decoded == words[at : at + 7] * 2
            assert lines == [b"".join(b"%d," % i for i in x) for x in plain[at : at + 7]] * 2
    assert all(len(x) <= codec.longest for x in codec.known) and len(codec.known) <= 5 + 14
