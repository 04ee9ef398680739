"""Byte-level BPE encoding and decoding with a two-tier lookup.

A minimal perfect hash over the vocabulary resolves a whole pre-token that is an entry. A pre-token that is none starts
as linked bytes; a heap of neighbouring pairs by rank merges them.
"""

from __future__ import annotations

import hashlib
from heapq import heapify, heappop, heappush
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from faultline.llm import pretokens, vocab
from faultline.llm.shared import column_of, portions, utf8

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)  # odd multipliers
_TOP = np.uint64(32)


def _prints(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64 bits of each stretch of ``flat``: a polynomial of its bytes, mixed. As many steps as the longest has bytes."""
    # Longest first, so the stretches that still have a byte are always the first ones.
    order = np.argsort(-lengths, kind="stable")
    begins, sizes = starts[order], lengths[order]
    mixed = sizes.astype(np.uint64) * _M2
    for k in range(int(sizes[0]) if len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -k, "left"))
        x = (mixed[:n] ^ flat[begins[:n] + k]) * _M1
        mixed[:n] = x ^ (x >> _TOP)
    out = np.empty(len(starts), np.uint64)
    out[order] = mixed
    return out


def _fingerprints(keys: list[bytes]) -> np.ndarray:
    lengths = np.fromiter(map(len, keys), np.int64, len(keys))
    return _prints(np.frombuffer(b"".join(keys), np.uint8), np.cumsum(lengths) - lengths, lengths)


def distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, longest: int) -> tuple[list[bytes], np.ndarray]:
    """Stretches of ``data`` with equal ones of up to ``longest`` bytes named once, and for each stretch its place among them.

    Fingerprints say which may be equal, their bytes whether they are; one that is not, and a longer one, stands for itself.
    """
    lengths = ends - starts
    short = np.flatnonzero(lengths <= longest)
    _, first, place = np.unique(_prints(data, starts[short], lengths[short]), return_index=True, return_inverse=True)
    own = short[first][place]
    differs = lengths[own] != lengths[short]
    for k in range(int(lengths[short].max(initial=0))):
        rows = np.flatnonzero((lengths[short] > k) & ~differs)
        differs[rows] = data[starts[short[rows]] + k] != data[starts[own[rows]] + k]
    alone = np.concatenate([short[differs], np.flatnonzero(lengths > longest)])
    which = np.empty(len(starts), np.int64)
    which[short] = place
    which[alone] = len(first) + np.arange(len(alone))
    named, whole = np.concatenate([short[first], alone]), data.tobytes()
    return [whole[a:b] for a, b in zip(starts[named].tolist(), ends[named].tolist())], which


def _mixed(prints: np.ndarray, seeds) -> np.ndarray:
    x = (prints ^ (np.asarray(seeds, np.uint64) * _M2)) * _M1
    x ^= x >> np.uint64(29)
    x *= _M2
    return x ^ (x >> _TOP)


class PerfectHash:
    """Hash and displace: buckets of keys, largest first, each get the first seed that sends them to free slots.

    As many slots as keys. A slot keeps its key's id; the key itself is compared by the caller.
    """

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.size, self.buckets = n, max(1, n // 3)
        prints = _fingerprints(keys)
        if len(np.unique(prints)) != n:
            raise ValueError("two entries share a fingerprint")
        bucket = (_mixed(prints, 0) % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        self.seeds = np.zeros(self.buckets, np.uint32)
        self.slots = np.full(n, -1, np.int32)
        tries = np.arange(1, 257, dtype=np.uint64)
        for b in np.argsort(-np.diff(bounds), kind="stable"):
            members = order[bounds[b] : bounds[b + 1]]
            if not len(members):
                break
            first = 0
            while True:
                at = (_mixed(prints[members][None, :], (tries + np.uint64(first))[:, None]) % np.uint64(n)).astype(np.int64)
                free = (self.slots[at] < 0).all(1)
                if len(members) > 1:
                    ordered = np.sort(at, axis=1)
                    free &= (ordered[:, 1:] != ordered[:, :-1]).all(1)
                if len(good := np.flatnonzero(free)):
                    self.seeds[b] = tries[good[0]] + np.uint64(first)
                    self.slots[at[good[0]]] = members
                    break
                first += len(tries)

    def lookup(self, keys: list[bytes]) -> np.ndarray:
        """For each key the number of the only entry it can be."""
        prints = _fingerprints(keys)
        seeds = self.seeds[(_mixed(prints, 0) % np.uint64(self.buckets)).astype(np.int64)]
        return self.slots[(_mixed(prints, seeds) % np.uint64(self.size)).astype(np.int64)]


class Codec:
    """Ids of pre-tokens and bytes of ids.

    A worker remembers the pre-tokens of up to ``longest`` bytes that it met lately: two generations of ``limit`` entries.
    When the young one is full the old one is forgotten, and what is still met moves from old to young.
    """

    def __init__(self, ranks: dict[bytes, int], table: PerfectHash, limit: int = 400_000):
        self.ranks, self.hash, self.limit = ranks, table, limit
        self.entries = list(ranks)
        self.entry_ids = list(ranks.values())
        self.longest = max(map(len, self.entries))
        self.bytes_of = {i: x for x, i in ranks.items()}
        self.line_of = {i: b"%d," % i for i in self.bytes_of}
        self.known: dict[bytes, tuple[bytes, bytes]] = {}
        self.old: dict[bytes, tuple[bytes, bytes]] = {}

    def merged(self, text: bytes) -> list[int]:
        """Ids of a pre-token that is no entry: lowest rank first, leftmost of equals, over linked bytes.

        A part goes from its place to ``follows`` of it. An entry of the heap is ``rank << 40 | place``; it is stale if the
        part at its place and the next one have another rank by now.
        """
        rank_of, n = self.ranks.get, len(text)
        follows, before = list(range(1, n + 1)), list(range(-1, n - 1))
        now = [rank_of(text[k : k + 2]) for k in range(n - 1)]
        now.append(None)
        heap = [r << 40 | k for k, r in enumerate(now) if r is not None]
        heapify(heap)
        while heap:
            top = heappop(heap)
            k = top & 0xFFFFFFFFFF
            if now[k] != top >> 40:
                continue
            right = follows[k]
            after = follows[k] = follows[right]
            now[right] = None
            if after < n:
                before[after] = k
                r = now[k] = rank_of(text[k : follows[after]])
                if r is not None:
                    heappush(heap, r << 40 | k)
            else:
                now[k] = None
            left = before[k]
            if left >= 0:
                r = now[left] = rank_of(text[left:after])
                if r is not None:
                    heappush(heap, r << 40 | left)
        out, k, ranks = [], 0, self.ranks
        while k < n:
            out.append(ranks[text[k : follows[k]]])
            k = follows[k]
        return out

    def encode(self, texts: list[bytes]) -> list[list[int]]:
        """Ids of each pre-token."""
        if not texts:
            return []
        out = []
        # What is longer than any entry is none.
        short = [x if len(x) <= self.longest else b"" for x in texts]
        for text, at in zip(texts, self.hash.lookup(short).tolist()):
            out.append([self.entry_ids[at]] if self.entries[at] == text else self.merged(text))
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def written(self, texts: list[bytes]) -> tuple[list[bytes], list[bytes]]:
        """For each pre-token its decimal ids, a comma after each, and the bytes its ids decode to."""
        if len(self.known) > self.limit:
            self.old, self.known = self.known, {}
        known, old = self.known, self.old
        found = list(map(known.get, texts))
        if places := [k for k, x in enumerate(found) if x is None]:
            missed = {texts[k]: None for k in places}
            new = [x for x in missed if x not in old]
            for text, ids in zip(new, self.encode(new)):
                missed[text] = b"".join(map(self.line_of.__getitem__, ids)), self.decode(ids)
            for text, pair in missed.items():
                if pair is None:
                    missed[text] = pair = old[text]
                if len(text) <= self.longest:
                    known[text] = pair
            for k in places:
                found[k] = missed[texts[k]]
        return list(map(itemgetter(0), found)), list(map(itemgetter(1), found))


_codecs: dict[str, Codec] = {}


def _codec(path: str, ranks: dict[bytes, int], table: PerfectHash) -> Codec:
    """One for all tasks of a worker process."""
    if path not in _codecs:
        _codecs.clear()
        _codecs[path] = Codec(ranks, table)
    return _codecs[path]


def round_trip(docs: DataFrame, ranks_path: str, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = False) -> DataFrame:
    """Encodes every text by the ranks in ``ranks_path`` and decodes the ids again.

    Columns: ``doc_id``, ``n_tokens``, ``ids_sha256`` of the decimal ids joined by commas, ``decoded_sha256`` of the
    decoded bytes, and with ``with_ids`` the ids. Null and empty texts have no ids; equal texts get equal rows; null ids
    stay; an empty table gives an empty result; other columns are not read.
    """
    ranks = vocab.read_ranks(ranks_path)
    # As large as the vocabulary, whatever the data.
    model = docs.sparkSession.sparkContext.broadcast((ranks, PerfectHash(list(ranks))))
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        codec = _codec(ranks_path, *model.value)
        for batch in portions(batches, text_column):
            data, offsets = utf8(column_of(batch, text_column))
            starts = pretokens.cuts(data, offsets)
            texts, which = distinct(data, starts, np.append(starts[1:], len(data)), codec.longest)
            at = np.searchsorted(starts, offsets)
            written, decoded = codec.written(texts)
            n, ids_sha, decoded_sha, ids = [], [], [], []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                own = which[a:b].tolist()
                line = b"".join(map(written.__getitem__, own))
                n.append(line.count(b","))
                ids_sha.append(hashlib.sha256(line[:-1]).hexdigest())
                decoded_sha.append(hashlib.sha256(b"".join(map(decoded.__getitem__, own))).hexdigest())
                if with_ids:
                    ids.append([int(x) for x in line.split(b",")[:-1]])
            columns = [column_of(batch, id_column), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns, names = [*columns, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.record_batch(columns, names)

    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(id_column, text_column).mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))
