"""Bigram language model in Elias-Fano tries, one for each shard of contexts, trained and applied by shards.

The unigram estimate p is (c + 0.5) / (N + 0.5 (V + 1)). After v, a word w has (1 - MIX) c(v w) / c(v) + MIX p(w), and
p(w) where v was never met; so the words after v sum to one at most. A trie has two levels, both monotone and
Elias-Fano coded: the contexts, with pointers to where their successors begin, and the successors, each found relative
to its context. Probabilities are kept as 16-bit codes of their logarithms.

1. Blocks of documents send their words to word shards, which answer with counts over the training documents and ids.
2. Blocks send their bigrams to the shard of the context, with the document each is in. The shard builds its trie from
   the training ones, writes it to a scratch file that it maps, looks all up, and answers with sums by document.
A context with more than a shard's share of all tokens is split by successor, which the counts of step 1 allow.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.elias_fano import EliasFano
from faultline.llm.exchange import ask, blocks, gathered, replies_of, rest_of, squeeze, unsqueeze, with_replies
from faultline.llm.shared import column_of

MIX = 0.6
BLOCK_BYTES = 6 << 20
SHARD_TOKENS = 2_000_000
_END = xxhash.xxh3_64_intdigest(b"")  # no word is empty
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LEAST = -16.0  # log10 of the smallest probability a code stands for
_ODD = np.uint64(0x9E3779B97F4A7C15)


def encode(data: np.ndarray, offsets: np.ndarray, train: np.ndarray) -> tuple[bytes, bytes]:
    """A block: each token's word, the word keys' upper bits, tokens by document, and who trains; and the words' hashes.
    Words are numbered as they are met, so frequent ones are small."""
    whole, at = _LOWER[data].tobytes(), offsets.tolist()
    local: dict[bytes, int] = {b"": 0}
    tokens, sizes = [], []
    for a, b in zip(at, at[1:]):
        words = whole[a:b].split()
        tokens += [local.setdefault(x, len(local)) for x in words]
        tokens.append(0)
        sizes.append(len(words) + 1)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, local), np.uint64, len(local))
    tokens = np.array(tokens, np.uint32)
    upper = (hashes >> np.uint64(40)).astype(np.uint32)
    split = [part for x in (tokens, upper) for part in ((x & 0xFFFF).astype(np.uint16), (x >> 16).astype(np.uint8))]
    if len(hashes) > 1 << 24:
        raise ValueError("a block has too many words")
    return squeeze(*split, np.array(sizes, np.int64), train), squeeze(hashes)


def _block(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each token's word, the words' shard keys, tokens by document, and who trains."""
    low, high, key_low, key_high, sizes, train = unsqueeze(body)
    return low.astype(np.int64) | high.astype(np.int64) << 16, key_low.astype(np.int64) | key_high.astype(np.int64) << 16, sizes, train


def _shards_of(values: np.ndarray, shards: int):
    order = np.argsort(values, kind="stable")
    bounds = np.searchsorted(values[order], np.arange(shards + 1))
    for shard in range(shards):
        if bounds[shard + 1] > bounds[shard]:
            yield shard, order[bounds[shard] : bounds[shard + 1]]


def count_words(messages: list[bytes]) -> tuple[list[bytes], tuple[int, int]]:
    """For each word its training count and its place by count in the shard; the shard's training tokens and words."""
    parts = [unsqueeze(x) for x in messages]
    words, place = np.unique(np.concatenate([x[0] for x in parts]), return_inverse=True)
    counts = np.bincount(place, np.concatenate([x[1] for x in parts]), len(words)).astype(np.int64)
    rank = np.empty(len(words), np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(words))
    bounds = np.cumsum([len(x[0]) for x in parts])[:-1]
    return [squeeze(_small(counts[x]), _small(rank[x])) for x in np.split(place, bounds)], (int(counts.sum()), int((counts > 0).sum()))


def _known(row, keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Training count and id (from 1, often met ones small; 0 stands for a text's begin) of a block's words."""
    counts, ids = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    replies = replies_of(row["words"])
    for shard, rows in _shards_of(keys % shards, shards):
        counts[rows], ranks = unsqueeze(replies[shard])
        ids[rows] = ranks.astype(np.int64) * shards + shard + 1
    return counts, ids


def _codes(p: np.ndarray) -> np.ndarray:
    return np.round(np.clip(np.log10(p) / _LEAST, 0, 1) * 65535).astype(np.uint16)


def _logs(codes: np.ndarray) -> np.ndarray:
    return codes.astype(np.float64) * (_LEAST / 65535)


class Trie:
    """A shard's training bigrams as mapped levels. Words are numbers below ``words``; pairs come sorted."""

    def __init__(self, folder: str, words: int, v: np.ndarray, w: np.ndarray, count: np.ndarray, contexts: np.ndarray, unigram: np.ndarray):
        first = np.concatenate([[True], v[1:] != v[:-1]]) if len(v) else np.zeros(0, bool)
        node, begin = np.cumsum(first) - 1, np.flatnonzero(first)
        levels = {
            "contexts": EliasFano(v[begin]), "starts": EliasFano(np.append(begin, len(v))),
            # One monotone run: a context's place times the number of words, plus the word.
            "successors": EliasFano(node * words + w)}
        codes = _codes((1 - MIX) * count / contexts[v] + MIX * unigram[w])
        self.words = words
        self.levels = {name: EliasFano(None, x.top, tuple(self._map(folder, f"{name}{k}", a) for k, a in enumerate(x.arrays)), x.low_bits, x.size) for name, x in levels.items()}
        self.codes = self._map(folder, "codes", codes)

    @staticmethod
    def _map(folder: str, name: str, array: np.ndarray) -> np.ndarray:
        path = os.path.join(folder, name)
        array.tofile(path)
        return np.memmap(path, array.dtype, "r") if len(array) else array

    def successors(self, context: int) -> tuple[np.ndarray, np.ndarray]:
        """The words met after a context and their log10 probabilities."""
        node = self.levels["contexts"].find(np.array([context]))
        if node[0] < 0:
            return np.zeros(0, np.int64), np.zeros(0)
        start, end = self.levels["starts"].at(np.concatenate([node, node + 1]))
        at = np.arange(start, end)
        return self.levels["successors"].at(at) - node[0] * self.words, _logs(self.codes[at])

    def logs(self, v: np.ndarray, w: np.ndarray, contexts: np.ndarray, unigram: np.ndarray) -> np.ndarray:
        """log10 probability of each w after v, pairs in order of v."""
        out = np.log10(unigram)[w] + np.where(contexts > 0, np.log10(MIX), 0.0)[v]
        if len(v):
            change = np.concatenate([[True], v[1:] != v[:-1]])
            node = self.levels["contexts"].find(v[change])[np.cumsum(change) - 1]
            rows = np.flatnonzero(node >= 0)
            at = self.levels["successors"].find(node[rows] * self.words + w[rows])
            out[rows[at >= 0]] = _logs(self.codes[at[at >= 0]])
        return out


def score_shard(messages: list[bytes], tokens: int, kinds: int) -> tuple[list[bytes], tuple[int, int]]:
    """For each block the sum of its log10 probabilities here, by document."""
    parts = [unsqueeze(x) for x in messages]
    ids, place = np.unique(np.concatenate([np.cumsum(x[0], dtype=np.int64) for x in parts]), return_inverse=True)
    counts = np.zeros(len(ids), np.int64)
    counts[place] = np.concatenate([x[1] for x in parts])
    unigram = (counts + 0.5) / (tokens + 0.5 * (kinds + 1))
    at = np.cumsum([0, *(len(x[0]) for x in parts)])
    m = np.int64(len(ids))
    keys = []
    for k, x in enumerate(parts):
        own = np.cumsum(x[2], dtype=np.int64)
        keys.append(place[at[k] + own // len(x[0])] * m + place[at[k] + own % len(x[0])])
    keys = np.concatenate(keys)
    weight = np.concatenate([x[4][x[3]] for x in parts])
    pairs, pair = np.unique(keys, return_inverse=True)
    del keys
    seen = np.bincount(pair, weight, len(pairs)).astype(np.int64)
    v, w = pairs // m, pairs % m
    known = seen > 0
    with tempfile.TemporaryDirectory() as folder:
        trie = Trie(folder, int(m), v[known], w[known], seen[known], counts, unigram)
        logs = trie.logs(v, w, counts, unigram)
        del trie
    replies, row = [], 0
    for x in parts:
        n = len(x[2])
        sums = np.bincount(x[3], logs[pair[row : row + n]], len(x[4]))
        docs = np.flatnonzero(np.bincount(x[3], minlength=len(x[4])))
        replies.append(squeeze(_small(np.diff(docs, prepend=0)), sums[docs]))
        row += n
    return replies, (0, 0)


def _small(x: np.ndarray) -> np.ndarray:
    top = int(x.max(initial=0))
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def _bigrams(row, shards: int, tokens: int, kinds: int, texts: int):
    """Messages to the shards of contexts, and one that comes back: the block's rows but for the model's score."""
    w, keys, sizes, train = _block(row["body"])
    counts, ids = _known(row, keys, shards)
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    base = np.bincount(doc, np.log10((counts + 0.5) / (tokens + 0.5 * (kinds + 1)))[w], len(sizes))
    met = np.bincount(doc, counts[w] > 0, len(sizes)).astype(np.int64)
    yield -1 - int(row["block"] % shards), squeeze(np.frombuffer(row["rest"], np.uint8), sizes, met, base)

    begin = len(keys)  # the context of a text's first token
    v = np.concatenate([[begin], w[:-1]])
    v[ends[:-1]] = begin
    ids, counts = np.append(ids, 0), np.append(counts, texts)
    # Shards of a context: its share of all tokens in shards, rounded up.
    spread = np.maximum(1, -(-counts * shards // max(1, tokens)))
    mixed = (ids.astype(np.uint64) * _ODD) >> np.uint64(20)
    owner = ((mixed % np.uint64(shards))[v] + mixed[w] % spread[v].astype(np.uint64)).astype(np.int64) % shards
    for shard, rows in _shards_of(owner, shards):
        used = np.zeros(begin + 1, bool)
        used[v[rows]] = used[w[rows]] = True
        used = np.flatnonzero(used)
        used = used[np.argsort(ids[used])]
        place = np.empty(begin + 1, np.int64)
        place[used] = np.arange(len(used))
        pair = place[v[rows]] * len(used) + place[w[rows]]
        order = np.argsort(pair, kind="stable")
        yield shard, squeeze(
            _small(np.diff(ids[used], prepend=0)), _small(counts[used]), _small(np.diff(pair[order], prepend=0)), _small(doc[rows[order]]), train)


def score(docs: DataFrame, held_out: Column, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Trains on the rows that are not ``held_out`` and scores all: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` and ``score``.

    Tokens are words between ASCII white space, A-Z in lower case, and one end for each text, so a null or empty text is
    one token. Words are told apart by 64-bit hashes. Rows that repeat are counted one by one; null ids stay; with no
    training row the counts are 0; an empty table gives an empty result; other columns are not read.
    """
    flag = "held_out" if id_column != "held_out" else "is_held_out"
    narrow = docs.select(F.col(id_column), F.col(text_column), held_out.alias(flag))

    def pack(data, offsets, batch):
        return encode(data, offsets, 1 - column_of(batch, flag).to_numpy(zero_copy_only=False).astype(np.uint8))

    def size(frames):
        for frame in frames:
            for body in frame["body"]:
                tokens, _, _, train = _block(body)
                yield pd.DataFrame({"tokens": [len(tokens)], "texts": [int(train.sum())]})

    found = blocks(narrow, text_column, [id_column, flag], pack, BLOCK_BYTES)
    every, texts = found.select("body").mapInPandas(size, "tokens long, texts long").agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("texts"), F.lit(0))).first()
    shards = max(1, -(-every // SHARD_TOKENS))

    def words(row):
        tokens, keys, sizes, train = _block(row["body"])
        (hashes,) = unsqueeze(row["more"])
        counts = np.bincount(tokens, np.repeat(train, sizes), len(hashes)).astype(np.int64)
        for shard, rows in _shards_of(keys % shards, shards):
            yield shard, squeeze(hashes[rows], _small(counts[rows]))

    counted = ask(found, words, count_words, ["body", "more"])
    tokens, kinds = counted.agg(F.coalesce(F.sum("one"), F.lit(0)), F.coalesce(F.sum("two"), F.lit(0))).first()
    known = with_replies(found.select("block", "rest", "body"), counted, "words")
    scored = ask(known, lambda row: _bigrams(row, shards, tokens, kinds, texts), lambda messages: score_shard(messages, tokens, kinds), ["body", "rest", "words"])

    def finish(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                replies = sorted(replies_of(column_of(batch, "sums")[k].as_py()).items())
                rest, sizes, met, base = unsqueeze(replies[0][1])
                total = np.zeros(len(sizes))
                for _, reply in replies[1:]:
                    gaps, sums = unsqueeze(reply)
                    total[np.cumsum(gaps, dtype=np.int64)] += sums
                rest = rest_of(rest.tobytes())
                yield pa.record_batch(
                    [rest.column(0), rest.column(1), pa.array(sizes), pa.array(met), pa.array(np.full(len(sizes), tokens)), pa.array(base), pa.array(total)],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kind = docs.schema[id_column].dataType.simpleString()
    return gathered(scored, "sums").select("sums").mapInArrow(
        finish, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
