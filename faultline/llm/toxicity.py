"""Toxicity of a text by subword-bag embeddings and a linear softmax.

A word is the average of the embeddings of itself and of its byte n-grams, hashed to a fixed number of rows; a passage
of ``SPAN`` words is the average of its words; a softmax over two classes follows. All are trained together in numpy.
A text is as toxic as its most toxic passage, so a few words count in a long text as in a short one. A misspelling that
was never seen shares most n-gram rows with the word it stems from.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.shared import column_of, portions, sampled

SPAN = 3
ROWS, DEPTH = 1 << 17, 8
GRAMS = (3, 4, 5, 6)
_WORD = re.compile(r"\w+")
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)  # odd multipliers


@dataclass
class Model:
    """Of fixed size: embeddings of hashed n-grams, weights and bias of the softmax (class 1 against class 0)."""

    grams: np.ndarray
    weights: np.ndarray
    bias: np.ndarray


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def features(vocabulary: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows of each word one after the other, and how many each word has."""
    raw = [b"<" + x.encode("utf-8", "surrogatepass") + b">" for x in vocabulary]
    sizes = np.array([len(x) for x in raw], np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(raw)), sizes)
    left = ends[owner] - np.arange(len(data))  # bytes from here to the word's end
    keys, owners = [], []
    for n in GRAMS:
        at = np.flatnonzero(left >= n)
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = (h ^ data[at + k]) * _M1
            h ^= h >> np.uint64(31)
        keys.append(h)
        owners.append(owner[at])
    # The whole word: the sum of its bytes' mixed values by place.
    place = (np.arange(len(data)) - (ends - sizes)[owner]).astype(np.uint64)
    mixed = (data + np.uint64(1)) * _M2 ^ (place + np.uint64(1)) * _M1
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _M2
    whole = np.add.reduceat(mixed, ends - sizes) if len(raw) else np.zeros(0, np.uint64)
    keys.append(whole ^ (whole >> np.uint64(33)))
    owners.append(np.arange(len(raw)))
    keys, owners = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return ((keys[order] * _M2) >> np.uint64(64 - 17)).astype(np.int64), np.bincount(owners, minlength=len(raw))


def word_values(values: np.ndarray, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each word the average of what its rows add. The softmax is linear, so this may come before the averages."""
    return np.add.reduceat(values[rows], np.cumsum(counts) - counts) / counts if len(counts) else np.zeros(0)


def spans(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and text of every passage: one from each word on that has ``SPAN`` words; a shorter
    text is one passage. Texts without words have none."""
    many = np.where(sizes == 0, 0, np.maximum(1, sizes - SPAN + 1))
    owner = np.repeat(np.arange(len(sizes)), many)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    first = (np.cumsum(sizes) - sizes)[owner] + within
    return first, np.minimum(SPAN, sizes[owner]), owner


def passages(values: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return (total[first + length] - total[first]) / length


def train(texts: Iterable[list[str]], labels: np.ndarray, steps: int = 150, rate: float = 0.1) -> Model:
    """Adam, first on all passages of all texts (each text counts once), then on the most toxic passage of each and all of clean ones."""
    rng = np.random.default_rng(3)
    number: dict[str, int] = {}
    # Numbers take the words' place at once: the texts are not held as lists of words.
    lines = [np.array([number.setdefault(x, len(number)) for x in text], np.int32) for text in texts]
    vocabulary, tokens, sizes = list(number), np.concatenate(lines), np.array([len(x) for x in lines], np.int64)
    many = len(lines)
    del number, lines
    rows, counts = features(vocabulary)
    rows, owner_word = rows.astype(np.int32), np.repeat(np.arange(len(vocabulary), dtype=np.int32), counts)
    first, length, owner = spans(sizes)
    begins = np.searchsorted(owner, np.arange(many))
    full = np.flatnonzero(sizes > 0)
    model = Model(rng.normal(0, 0.1, (ROWS, DEPTH)), rng.normal(0, 0.5, (DEPTH, 2)), np.zeros(2))
    names = ("grams", "weights", "bias")
    m1 = {x: np.zeros_like(getattr(model, x)) for x in names}
    m2 = {x: np.zeros_like(getattr(model, x)) for x in names}
    share = np.bincount(labels[full], minlength=2).clip(1)
    weight = len(full) / 2 / share[labels]
    clean = np.flatnonzero(labels[owner] == 0)
    per_text = weight[owner] / np.maximum(np.bincount(owner, minlength=many), 1)[owner]
    for step in range(1, steps + 1):
        way = model.weights[:, 1] - model.weights[:, 0]
        gap = word_values(model.grams @ way, rows, counts)
        logit = passages(gap[tokens], first, length) + model.bias[1] - model.bias[0]
        if step <= steps // 6:
            chosen, strength = np.arange(len(first)), per_text
        else:
            top = np.maximum.reduceat(logit, begins[full])
            hit = np.flatnonzero(logit == np.repeat(top, np.diff(np.append(begins[full], len(logit)))))
            best = hit[np.unique(owner[hit], return_index=True)[1]]
            # No passage of a clean text is toxic; of a toxic one only the most toxic is known to be.
            chosen = np.concatenate([best, clean])
            strength = np.concatenate([weight[owner[best]], per_text[clean]])
        slope = (1 / (1 + np.exp(-logit[chosen])) - labels[owner[chosen]]) * strength / len(full)
        # Each passage's slope is spread over its words.
        each = slope / length[chosen]
        edge = np.bincount(first[chosen], each, len(tokens) + 1) - np.bincount(first[chosen] + length[chosen], each, len(tokens) + 1)
        by_word = np.bincount(tokens, np.cumsum(edge)[:-1], len(vocabulary))
        by_row = np.bincount(rows, (by_word / counts)[owner_word], ROWS)
        side = by_row @ model.grams
        grads = {
            "grams": by_row[:, None] * way, "weights": np.stack([-side, side], 1) + 1e-4 * model.weights,
            "bias": np.array([-slope.sum(), slope.sum()])}
        for name in names:
            m1[name] = 0.9 * m1[name] + 0.1 * grads[name]
            m2[name] = 0.99 * m2[name] + 0.01 * grads[name] ** 2
            move = rate * (m1[name] / (1 - 0.9**step)) / (np.sqrt(m2[name] / (1 - 0.99**step)) + 1e-9)
            setattr(model, name, getattr(model, name) - move)
    return model


def fit(docs: DataFrame, labels: DataFrame, usable: Column, sample_per_class: int = 2500, max_bytes: int = 8_000, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic") -> Model | None:
    """Learns from at most ``sample_per_class`` labelled texts of each class, none longer than ``max_bytes``, among the
    ids that ``usable`` admits, by order of a hash of the id. None where a class has no text."""
    known = labels.filter(usable & F.col(label_column).isin(0, 1)).select(id_column, F.col(label_column).cast("int").alias("label")).distinct()
    short = docs.filter(usable & (F.octet_length(text_column) <= max_bytes)).select(id_column)
    chosen = sampled(known.join(short, id_column, "left_semi"), id_column, "label", sample_per_class)
    # Few rows by the bounds above, whatever the tables' size.
    sample = docs.filter(usable & (F.octet_length(text_column) <= max_bytes)).select(id_column, text_column).join(F.broadcast(chosen), id_column)
    rows = sorted((x[0], x.label, x[1]) for x in sample.select(id_column, text_column, "label").collect())
    found = np.array([x[1] for x in rows], np.int64)
    if len(np.unique(found)) < 2:
        return None
    return train((words(x[2]) for x in rows), found)


class Scorer:
    """Remembers what each word adds to a passage; at most ``limit`` words."""

    def __init__(self, model: Model, limit: int = 500_000):
        self.grams, self.limit = model.grams @ (model.weights[:, 1] - model.weights[:, 0]), limit
        self.bias = float(model.bias[1] - model.bias[0])
        self.known: dict[str, float] = {}

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if len(self.known) > self.limit:
            self.known.clear()
        lists = [words(x) for x in texts]
        flat = [x for one in lists for x in one]
        found = list(map(self.known.get, flat))
        if new := list({x for x, value in zip(flat, found) if value is None}):
            rows, counts = features(new)
            self.known.update(zip(new, word_values(self.grams, rows, counts).tolist()))
            found = list(map(self.known.__getitem__, flat))
        total = np.concatenate([[0.0], np.cumsum(np.array(found, np.float64))])
        sizes = np.array([len(x) for x in lists], np.int64)
        ends = np.cumsum(sizes)
        logit = np.where(sizes > 0, (total[ends] - total[ends - sizes]) / np.maximum(sizes, 1), 0.0)
        if len(long := np.flatnonzero(sizes > SPAN)):
            sums = np.append(total[SPAN:] - total[:-SPAN], -np.inf)
            edges = np.stack([(ends - sizes)[long], ends[long] - SPAN + 1], 1).ravel()
            logit[long] = np.maximum.reduceat(sums, edges)[::2] / SPAN
        return 1 / (1 + np.exp(-np.clip(logit + self.bias, -50, 50)))


def score(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1, higher for toxic) of every row, from its whole text alone.

    A null or empty text, or one without words, gets the score of the bias alone; where nothing could be learned all
    scores are 0. Equal texts get equal scores; null ids stay; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        scorer = Scorer(shared.value) if shared.value else None
        for batch in portions(batches, text_column):
            texts = column_of(batch, text_column).to_pylist()
            found = scorer.scores(texts) if scorer else np.zeros(len(texts))
            yield pa.record_batch([column_of(batch, id_column), pa.array(found)], ["doc_id", "score"])

    return docs.select(id_column, text_column).mapInArrow(run, f"doc_id {kind}, score double")
