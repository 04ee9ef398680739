"""Token counts by a compiled finite-state tokenizer.

Two deterministic transducers in a row. The first (``pretokens``) marks where a pre-token starts; chunks of bytes are
maps between its states, composed by a parallel prefix scan. The second counts tokens inside a pre-token: reading a
byte, it emits by how much the number of tokens of the prefix read so far changes (0, 1, or negative where a merge
swallows earlier tokens). Its states hold, for each position from which a vocabulary entry may still grow, the last
token before that position and the count there. States and transitions are compiled when first met.

A prefix's last token is the one suffix in the vocabulary that stands next to the last token before it also when the
two are tokenized together; this determines the tokens of all prefixes from left to right.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from faultline.llm import pretokens, vocab
from faultline.llm.shared import column_of, portions, utf8


class Counter:
    """The second transducer. ``limit`` bounds its compiled transitions and the whole pre-tokens it remembers."""

    def __init__(self, tokens: dict[bytes, int], merges: list[tuple[bytes, bytes]], limit: int = 600_000):
        self.limit = limit
        self.bytes_of = {i: x for x, i in tokens.items()}
        self.ids = [tokens[bytes([b])] for b in range(256)]
        self.merge = {(tokens[a], tokens[b]): (rank, tokens[a + b]) for rank, (a, b) in enumerate(merges)}
        self.parts = {tokens[a + b]: (tokens[a], tokens[b], rank) for rank, (a, b) in reversed(list(enumerate(merges)))}
        for rank, (a, b) in enumerate(merges):
            if any(len(x) > 1 and self.parts[tokens[x]][2] > rank for x in (a, b)):
                raise ValueError("a merge stands before those that make its parts")
        # The trie of the vocabulary: (node, byte) leads on; a node may end a token.
        self.trie: dict[int, int] = {}
        self.ends: list[int] = [-1]
        for text, i in tokens.items():
            node = 0
            for b in text:
                key = node << 8 | b
                node = self.trie.get(key, 0)
                if not node:
                    node = self.trie[key] = len(self.ends)
                    self.ends.append(-1)
            self.ends[node] = i
        self.inner = set(key >> 8 for key in self.trie)
        self.edges: tuple[dict, dict] = ({}, {})
        self.whole: dict[bytes, int] = {}
        self._forget()

    def _forget(self) -> None:
        # A state is a tuple of (last token, trie node, count relative to the whole prefix).
        self.known = {((-1, 0, 0),): 0}
        self.states = [((-1, 0, 0),)]
        self.moves: dict[int, tuple[int, int]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, int, int]]:
        """What stands at one edge of ``token`` while its bytes are merged, with the ranks from and before which it does."""
        if (found := self.edges[side].get(token)) is None:
            found, until = [], 1 << 60
            while token in self.parts:
                found.append((token, self.parts[token][2], until))
                until, token = self.parts[token][2], self.parts[token][side]
            found = self.edges[side][token if not found else found[0][0]] = [*found, (token, -1, until)]
        return found

    def _adjacent(self, a: int, b: int) -> bool:
        """Whether ``a`` then ``b`` is how their joined bytes are tokenized: no merge across falls due before both ends change."""
        if (found := self.pairs.get((a, b))) is None:
            found = True
            for x, x_from, x_until in self._edge(a, 1):
                for y, y_from, y_until in self._edge(b, 0):
                    rank = self.merge.get((x, y), (-1,))[0]
                    # At one rank the left pair goes first.
                    if rank > x_from and rank > y_from and rank < x_until and rank <= y_until:
                        found = False
            self.pairs[a, b] = found
        return found

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        grown, last, emitted = [], -1, 0
        for before, node, count in self.states[state]:
            node = self.trie.get(node << 8 | byte, 0)
            if not node:
                continue
            token = self.ends[node]
            if token >= 0 and last < 0 and (before < 0 or self._adjacent(before, token)):
                last, emitted = token, count + 1
            if node in self.inner:
                grown.append((before, node, count))
        new = (*((before, node, count - emitted) for before, node, count in grown), (last, 0, 0))
        at = self.known.setdefault(new, len(self.states))
        if at == len(self.states):
            self.states.append(new)
        self.moves[state << 8 | byte] = at, emitted
        return at, emitted

    def count(self, text: bytes) -> int:
        """Tokens of one pre-token."""
        state, total = 0, 0
        for byte in text:
            move = self.moves.get(state << 8 | byte)
            state, emitted = move or self._compile(state, byte)
            total += emitted
        return total

    def counts(self, texts: list[bytes]) -> list[int]:
        if len(self.whole) > self.limit:
            self.whole.clear()
        whole = self.whole
        out = list(map(whole.get, texts))
        for k in (k for k, n in enumerate(out) if n is None):
            text = texts[k]
            if (n := whole.get(text)) is None:
                n = self.count(text)
                if len(text) < 64:
                    whole[text] = n
            out[k] = n
            if len(self.moves) > self.limit:
                self._forget()
        return out


def _special_strings(data: np.ndarray, offsets: np.ndarray, special: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """How many special strings each text has, and where they start and end."""
    whole, found = data.tobytes(), []
    for text in special:
        at = whole.find(text)
        while at >= 0:
            row = int(np.searchsorted(offsets, at, "right")) - 1
            if at + len(text) <= offsets[row + 1]:
                found.append((at, at + len(text), row))
                at = whole.find(text, at + len(text))
            else:
                at = whole.find(text, at + 1)
    found.sort()
    extra = np.bincount([x[2] for x in found], minlength=len(offsets) - 1)
    return extra, np.array([x[:2] for x in found], np.int64).reshape(-1, 2)


def count_batch(counter: Counter, special: list[bytes], data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Tokens of each text."""
    extra, holes = _special_strings(data, offsets, special)
    inside = np.zeros(len(data) + 1, bool)
    if len(holes):
        # Special strings are left out; what stands around them are texts of their own.
        for a, b in holes.tolist():
            inside[a:b] = True
        kept = np.cumsum(~inside) - ~inside
        bounds = np.unique(np.concatenate([kept[offsets], kept[holes[:, 0]]]))
        offsets, data = kept[offsets], data[~inside[:-1]]
    else:
        bounds = offsets
    texts, _ = pretokens.pieces(data, bounds)
    totals = np.concatenate([[0], np.cumsum(np.array(counter.counts(texts), np.int64))])
    lengths = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
    at = totals[np.searchsorted(lengths, offsets)]
    return np.diff(at) + extra


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 1024, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes`` of UTF-8, ``n_tokens``, and whether they are more than ``limit``, for every row.

    ``tokenizer_path`` is a byte-level ``tokenizers`` file; its special strings count as one token each where they
    stand in a text. Null and empty texts have no bytes and no tokens; rows that repeat are counted one by one, null ids
    stay; an empty table gives an empty result; other columns are not read.
    """
    tokens, merges, special = vocab.read_json(tokenizer_path)
    model = docs.sparkSession.sparkContext.broadcast((tokens, merges, sorted(special)))
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        tokens, merges, special = model.value
        counter = _counter(tokenizer_path, tokens, merges)
        for batch in portions(batches, text_column):
            data, offsets = utf8(column_of(batch, text_column))
            n = count_batch(counter, special, data, offsets)
            yield pa.record_batch([column_of(batch, id_column), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(id_column, text_column).mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


_counters: dict[str, Counter] = {}


def _counter(path: str, tokens, merges) -> Counter:
    """One for all tasks of a worker process."""
    if path not in _counters:
        _counters.clear()
        _counters[path] = Counter(tokens, merges)
    return _counters[path]
