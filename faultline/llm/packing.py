"""Packs documents into training sequences with their lexical neighbours.

Documents are tokenized into shards. A shard holds a BM25 inverted index over the token ids of its documents, with
document frequencies and lengths of the whole corpus. Full windows of a long document stand alone; what is left of it
seeds a window that unused neighbours, best score first, greedily fill. The last one is cut where the window ends and
its rest goes back. What remains at a shard's end is laid out in lengths that are powers of two, so nothing is padded.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm import pretokens, vocab
from faultline.llm.shared import column_of, kept, portions, saved, tidy, utf8

WINDOW = 1024
SHARD_DOCS, SHARD_TOKENS = 2048, 4_000_000
K1, B = 1.2, 0.75
BATCH = 32  # seeds scored at once
DENSE_TERMS, DENSE_DOCS = 2048, 16  # a shard's most frequent terms are columns of a matrix; fewer documents make a list
DOCUMENT_END = 0


class Tokenizer:
    """Token ids of texts as the bytes of 32-bit or, where they fit, 16-bit numbers. ``limit`` bounds remembered pre-tokens."""

    def __init__(self, tokens: dict[bytes, int], special: dict[bytes, int], limit: int = 1_000_000):
        self.dtype = np.dtype("<u2" if max([*tokens.values(), *special.values()]) < 1 << 16 else "<u4")
        self.special, self.limit = special, limit
        self.core = tiktoken.Encoding("vocabulary", pat_str=r"[\s\S]+", mergeable_ranks=tokens, special_tokens={})._core_bpe
        self.known: dict[bytes, bytes] = {}

    def _pieces(self, texts: list[bytes]) -> list[bytes]:
        if len(self.known) > self.limit:
            self.known.clear()
        known = self.known
        found = list(map(known.get, texts))
        for k in (k for k, x in enumerate(found) if x is None):
            text = texts[k]
            if (ids := known.get(text)) is None:
                ids = np.array(self.core.encode_single_piece(text), self.dtype).tobytes()
                if len(text) < 64:
                    known[text] = ids
            found[k] = ids
        return found

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Ids of each text, the id that ends a document included."""
        end = np.array([DOCUMENT_END], self.dtype).tobytes()
        whole = data.tobytes()
        if any(x in whole for x in self.special):
            return [self._with_special(whole[a:b]) + end for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        texts, at = pretokens.pieces(data, offsets)
        found = self._pieces(texts)
        return [b"".join(found[a:b]) + end for a, b in zip(at[:-1].tolist(), at[1:].tolist())]

    def _with_special(self, text: bytes) -> bytes:
        """A special string is its own id wherever it stands; what is between is text of its own."""
        at = min(((text.find(x), x) for x in self.special if x in text), default=None)
        if at is None:
            texts, _ = pretokens.pieces(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
            return b"".join(self._pieces(texts))
        start, special = at
        rest, out = text, []
        while start >= 0:
            out += [self._with_special(rest[:start]), np.array([self.special[special]], self.dtype).tobytes()]
            rest = rest[start + len(special) :]
            start, special = min(((rest.find(x), x) for x in self.special if x in rest), default=(-1, b""))
        return b"".join(out) + self._with_special(rest)


def _tokenizer(path: str, tokens, special) -> Tokenizer:
    """One for all tasks of a worker process, until one of another stage lets it go."""
    if path not in kept:
        kept.clear()
        kept[path] = Tokenizer(tokens, special)
    return kept[path]


def tokenized(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Shards of documents in table order: their ids, token counts, and all tokens in one compressed value."""
    tokens, _, special = vocab.read_json(tokenizer_path)
    model = docs.sparkSession.sparkContext.broadcast((tokens, special))
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        coder = _tokenizer(tokenizer_path, *model.value)
        ids, lists, size = [], [], 0

        def shard():
            counts = np.array([len(x) // coder.dtype.itemsize for x in lists], np.int64)
            blob = zstandard.ZstdCompressor(level=1).compress(b"".join(lists))
            return pa.record_batch([
                pa.array([ids], pa.list_(id_type)), pa.array([counts.tobytes()], pa.binary()), pa.array([blob], pa.binary()),
                pa.array([len(counts)], pa.int64()), pa.array([int(counts.sum())], pa.int64())], ["ids", "counts", "tokens", "n_docs", "n_tokens"])

        for batch in portions(batches, text_column):
            column = column_of(batch, id_column)
            id_type = column.type
            for doc, found in zip(column.to_pylist(), coder.encode(*utf8(column_of(batch, text_column)))):
                ids.append(doc)
                lists.append(found)
                size += len(found) // coder.dtype.itemsize
                if len(ids) >= SHARD_DOCS or size >= SHARD_TOKENS:
                    yield shard()
                    ids, lists, size = [], [], 0
        if ids:
            yield shard()

    return docs.select(id_column, text_column).mapInArrow(run, f"ids array<{kind}>, counts binary, tokens binary, n_docs long, n_tokens long")


def _read(tokens: bytes, counts: bytes, width: str) -> tuple[np.ndarray, np.ndarray]:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(tokens), width)
    return flat, np.concatenate([[0], np.cumsum(np.frombuffer(counts, np.int64))])


def _terms(flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, term and frequency, by document and term."""
    kind, bits = (np.uint32, 16) if flat.itemsize == 2 and len(at) <= 1 << 16 else (np.uint64, 32)
    key = np.repeat(np.arange(len(at) - 1, dtype=kind), np.diff(at)) << kind(bits) | flat
    key, tf = np.unique(key, return_counts=True)
    return (key >> kind(bits)).astype(np.int64), (key & kind((1 << bits) - 1)).astype(np.int64), tf


class Index:
    """BM25 over the documents of a shard. Postings of frequent terms are columns of a matrix, others are lists by term."""

    def __init__(self, flat: np.ndarray, at: np.ndarray, frequency: np.ndarray, n_docs: int, mean_length: float):
        doc, term, tf = _terms(flat, at)
        length = np.diff(at)[doc]
        idf = np.log1p((n_docs - frequency[term] + 0.5) / (frequency[term] + 0.5))
        weight = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean_length))
        count = np.bincount(term, minlength=len(frequency))
        most = np.argsort(-count, kind="stable")[:DENSE_TERMS]
        most = most[count[most] >= DENSE_DOCS]
        column = np.full(len(frequency), -1, np.int64)
        column[most] = np.arange(len(most))
        dense = column[term] >= 0
        self.held = np.arange(len(at) - 1)  # documents that are rows of the matrix
        self.matrix = np.zeros((len(at) - 1, len(most)), np.float32)
        self.matrix[doc[dense], column[term[dense]]] = weight[dense]
        doc, term, weight = doc[~dense], term[~dense], weight[~dense]
        self.bounds, self.term = np.searchsorted(doc, np.arange(len(at))), term
        order = np.argsort(term, kind="stable")
        self.docs, self.posted = doc[order], weight[order]
        self.terms = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(frequency)))])

    def scores(self, seeds: np.ndarray, used: np.ndarray) -> np.ndarray:
        """For each of the unused ``seeds`` the scores of all documents by all its terms; used ones may have none."""
        if 4 * np.count_nonzero(~used) < 3 * len(self.held):
            left = ~used[self.held]
            self.held, self.matrix = self.held[left], self.matrix[left]
        asked = (self.matrix[np.searchsorted(self.held, seeds)] > 0).astype(np.float32)
        out = np.zeros((len(seeds), len(used)), np.float32)
        out[:, self.held] = asked @ self.matrix.T
        for k, doc in enumerate(seeds.tolist()):
            terms = self.term[self.bounds[doc] : self.bounds[doc + 1]]
            start, size = self.terms[terms], self.terms[terms + 1] - self.terms[terms]
            ends = np.cumsum(size)
            if len(ends):
                at = np.arange(ends[-1]) + np.repeat(start - (ends - size), size)
                out[k] += np.bincount(self.docs[at], self.posted[at], len(used))
        # Equal documents tie whatever the order in which the product adds; scores are tens to thousands.
        return np.round(out, 3)


def neighbours(scores: np.ndarray, used: np.ndarray):
    """Unused documents of a score, best first, ties by place."""
    found = np.flatnonzero((scores > 0) & ~used)
    # Few are needed to fill a window: the first ones are sorted alone.
    if len(found) > 64:
        least = np.partition(scores[found], -32)[-32]
        first = found[scores[found] >= least]
        yield from first[np.argsort(-scores[first], kind="stable")].tolist()
        found = found[scores[found] < least]
    yield from found[np.argsort(-scores[found], kind="stable")].tolist()


def layout(at: np.ndarray, index: Index) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length) that hold every token once."""
    out, sizes = [], np.diff(at)
    begin = sizes // WINDOW * WINDOW
    for doc in np.flatnonzero(begin):
        out.extend([(int(doc), start, WINDOW)] for start in range(0, int(begin[doc]), WINDOW))
    left = sizes - begin
    used, scored = left == 0, {}
    order = np.argsort(-left, kind="stable")
    for place, seed in enumerate(order.tolist()):
        if used[seed]:
            continue
        if seed not in scored:
            seeds = order[place : place + 4 * BATCH]
            seeds = seeds[~used[seeds]][:BATCH]
            scored = dict(zip(seeds.tolist(), index.scores(seeds, used)))
        row, room = [(seed, int(begin[seed]), int(left[seed]))], WINDOW - int(left[seed])
        used[seed] = True
        for source in ("neighbours", "any"):
            if not room:
                break
            for doc in neighbours(scored[seed], used) if source == "neighbours" else np.flatnonzero(~used).tolist():
                n = min(room, int(left[doc]))
                row.append((doc, int(begin[doc]), n))
                begin[doc] += n
                left[doc] -= n
                room -= n
                used[doc] = left[doc] == 0
                if not room:
                    break
        out.append(row)
    # Only the last window of a shard can have room; it goes into powers of two.
    if out and sum(n for *_, n in out[-1]) < WINDOW:
        rest = out.pop()
        size = sum(n for *_, n in rest)
        for bit in reversed(range(WINDOW.bit_length() - 1)):
            if size >> bit & 1:
                row, room = [], 1 << bit
                while room:
                    doc, start, n = rest.pop(0)
                    taken = min(n, room)
                    row.append((doc, start, taken))
                    room -= taken
                    if taken < n:
                        rest.insert(0, (doc, start + taken, n - taken))
                out.append(row)
    return out


def pack(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = False) -> DataFrame:
    """One row for every piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``,
    ``offset``, and with ``with_ids`` the token ids.

    A document is its tokens (special strings count as in the library) and then id 0, so a null or empty text is one
    token. Equal documents are packed one by one, null ids stay, an empty table gives an empty result; other columns
    are not read. Sequences hold 1024 tokens or, at a shard's end, a smaller power of two.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    tokens, _, special = vocab.read_json(tokenizer_path)
    size = max([*tokens.values(), *special.values()]) + 1
    width = "<u2" if size <= 1 << 16 else "<u4"
    shards = saved(tokenized(docs, tokenizer_path, id_column, text_column))

    def frequencies(frames):
        total = np.zeros(size, np.int64)
        for frame in frames:
            for tokens, counts in zip(frame["tokens"], frame["counts"]):
                total += np.bincount(_terms(*_read(tokens, counts, width))[1], minlength=size)
        found = np.flatnonzero(total)
        yield pd.DataFrame({"term": found, "docs": total[found]})

    # One row for each entry of the vocabulary at most.
    frequency = np.zeros(size, np.int64)
    for term, n in shards.select("tokens", "counts").mapInPandas(tidy(frequencies), "term long, docs long").groupBy("term").agg(F.sum("docs")).collect():
        frequency[term] = n
    n_docs, n_tokens = shards.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    shared = docs.sparkSession.sparkContext.broadcast((frequency, n_docs, n_tokens / max(1, n_docs)))

    def run(batches):
        # A task's shards are the same ones at every attempt.
        sequence = TaskContext.get().partitionId() << 32
        for batch in batches:
            for row in range(batch.num_rows):
                ids = column_of(batch, "ids")[row].values
                flat, at = _read(column_of(batch, "tokens")[row].as_py(), column_of(batch, "counts")[row].as_py(), width)
                wide = flat.astype("<u4")
                pieces = []
                for line in layout(at, Index(flat, at, *shared.value)):
                    offset = 0
                    for doc, start, n in line:
                        pieces.append((doc, start, n, zlib.crc32(wide[at[doc] + start : at[doc] + start + n]), sequence, offset))
                        offset += n
                    sequence += 1
                doc, start, n, crc, number, offset = (np.array(x, np.int64) for x in zip(*pieces))
                columns = [ids.take(pa.array(doc)), *map(pa.array, (start, n, crc, np.diff(at)[doc], number, offset))]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
                if with_ids:
                    columns.append(pa.array([wide[at[d] + s : at[d] + s + c].astype(np.int32) for d, s, c, *_ in pieces], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.record_batch(columns, names)

    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return shards.select("ids", "counts", "tokens").mapInArrow(tidy(run), schema + (", ids array<int>" if with_ids else ""))
