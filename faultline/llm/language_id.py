"""Language of a text by a byte convolutional network.

Bytes are embedded, filters of several widths slide over a window of fixed length, each keeps its largest answer, and
a softmax turns these into languages. Trained in numpy on a bounded sample of labelled texts; applied to all windows of
a text, whose probabilities are averaged by window length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.shared import column_of, portions, sampled, tidy, utf8

WINDOW = 256
WIDTHS = (2, 3, 4, 5)
FILTERS = 12  # of each width
DEPTH = 6  # of a byte's embedding
UNKNOWN = "und"


@dataclass
class Model:
    """``languages`` in order; arrays of 32-bit floats. Its size does not depend on the data."""

    languages: list[str]
    bytes_: np.ndarray
    filters: np.ndarray
    shift: np.ndarray
    weights: np.ndarray
    bias: np.ndarray


def _patches(embedded: np.ndarray) -> np.ndarray:
    """(windows, positions, widest x depth): the embeddings from each position on, zeros past the end."""
    n, length, depth = embedded.shape
    widest = max(WIDTHS)
    out = np.zeros((n, length, widest * depth), np.float32)
    for k in range(widest):
        out[:, : length - k, k * depth : (k + 1) * depth] = embedded[:, k:]
    return out


def _answers(model: Model, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    patches = _patches(model.bytes_[windows])
    out = patches.reshape(-1, patches.shape[2]) @ model.filters
    out = out.reshape(len(windows), windows.shape[1], -1)
    for k in np.flatnonzero(lengths < windows.shape[1]):
        out[k, max(1, lengths[k]) :] = -np.inf
    return patches, out


def probabilities(model: Model, windows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    _, out = _answers(model, windows, lengths)
    hidden = np.maximum(out.max(axis=1) + model.shift, 0)
    logits = hidden @ model.weights + model.bias
    logits = np.exp(logits - logits.max(axis=1, keepdims=True))
    return logits / logits.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 6, rate: float = 4e-3, batch: int = 64) -> Model:
    """Adam on the cross entropy; half of the windows of a batch are cut short, so that short texts are learned too."""
    rng = np.random.default_rng(1)
    many = FILTERS * len(WIDTHS)
    mask = np.zeros((max(WIDTHS) * DEPTH, many), np.float32)
    for k, width in enumerate(WIDTHS):
        mask[: width * DEPTH, k * FILTERS : (k + 1) * FILTERS] = 1
    model = Model(
        languages, rng.normal(0, 0.5, (256, DEPTH)).astype(np.float32),
        (rng.normal(0, 0.3, mask.shape) * mask).astype(np.float32), np.zeros(many, np.float32),
        rng.normal(0, 0.1, (many, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32))
    names = ("bytes_", "filters", "shift", "weights", "bias")
    first = {x: np.zeros_like(getattr(model, x)) for x in names}
    second = {x: np.zeros_like(getattr(model, x)) for x in names}
    step, shares = 0, np.maximum(np.bincount(labels, minlength=len(languages)), 1)
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            x, y, n = windows[rows], labels[rows], lengths[rows].copy()
            cut = rng.random(len(rows)) < 0.5
            n[cut] = np.minimum(n[cut], rng.integers(12, WINDOW, cut.sum()))
            x = np.where(np.arange(WINDOW) < n[:, None], x, 0)
            patches, out = _answers(model, x, n)
            best = out.argmax(axis=1)
            top = np.take_along_axis(out, best[:, None, :], 1)[:, 0] + model.shift
            hidden = np.maximum(top, 0)
            logits = hidden @ model.weights + model.bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            p *= (len(labels) / len(languages) / shares[y])[:, None] / len(rows)
            back = (p @ model.weights.T) * (top > 0)
            chosen = patches[np.arange(len(x))[:, None], best]  # (windows, filters, widest x depth)
            into = back[:, :, None] * model.filters.T[None] * mask.T[None]
            grads = {
                "weights": hidden.T @ p, "bias": p.sum(0), "shift": back.sum(0),
                "filters": np.einsum("nf,nfd->df", back, chosen) * mask, "bytes_": np.zeros_like(model.bytes_)}
            spots = best[:, :, None] + np.arange(max(WIDTHS))
            inside = spots < WINDOW
            which = x[np.arange(len(x))[:, None, None], np.minimum(spots, WINDOW - 1)]
            parts = into.reshape(*spots.shape, DEPTH) * inside[..., None]
            for d in range(DEPTH):
                grads["bytes_"][:, d] = np.bincount(which.ravel(), parts[..., d].ravel(), 256)
            step += 1
            for name in names:
                first[name] = 0.9 * first[name] + 0.1 * grads[name]
                second[name] = 0.999 * second[name] + 0.001 * grads[name] ** 2
                move = rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                setattr(model, name, (getattr(model, name) - move).astype(np.float32))
    return model


def cut_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of the windows that cover every text, and the row each belongs to."""
    sizes = np.diff(offsets)
    per_row = -(-sizes // WINDOW)
    rows = np.repeat(np.arange(len(sizes)), per_row)
    within = np.arange(len(rows)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    starts = offsets[:-1][rows] + within * WINDOW
    return starts, np.minimum(WINDOW, offsets[1:][rows] - starts), rows


def gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The windows' bytes, zeros past a window's end."""
    at = starts[:, None] + np.arange(WINDOW)
    return np.where(np.arange(WINDOW) < lengths[:, None], data[np.minimum(at, len(data) - 1)], 0)


def fit(docs: DataFrame, usable: Column, sample_per_language: int = 400, windows_per_text: int = 6, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang") -> Model | None:
    """Learns from at most ``sample_per_language`` texts of each label among the ``usable`` rows (by order of a hash of
    the id), and at most ``windows_per_text`` windows spread over each whole text. None if there is no label."""
    labelled = docs.filter(usable & F.col(label_column).isNotNull() & F.col(text_column).isNotNull() & F.col(id_column).isNotNull())
    chosen = sampled(labelled.select(id_column, label_column), id_column, label_column, sample_per_language).select(id_column).distinct()

    def run(batches):
        for batch in portions(batches, text_column):
            data, offsets = utf8(column_of(batch, text_column))
            starts, lengths, rows = cut_windows(data, offsets)
            count = np.bincount(rows, minlength=batch.num_rows)
            within = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
            stride = np.maximum(1, -(-count // windows_per_text))[rows]
            kept = np.flatnonzero(within % stride == 0)
            labels = column_of(batch, "label").to_pylist()
            yield pa.record_batch([
                pa.array([labels[k] for k in rows[kept]], pa.string()),
                pa.array([data[a : a + n].tobytes() for a, n in zip(starts[kept].tolist(), lengths[kept].tolist())], pa.binary())], ["label", "bytes"])

    # The chosen ids are few by the two bounds above, whatever the table's size.
    sample = docs.filter(usable).join(F.broadcast(chosen), id_column, "left_semi")
    sample = sample.filter(F.col(label_column).isNotNull()).select(F.col(label_column).cast("string").alias("label"), text_column)
    rows = sorted((x.label, bytes(x.bytes)) for x in sample.mapInArrow(tidy(run), "label string, bytes binary").collect())
    if not rows:
        return None
    languages = sorted({x for x, _ in rows})
    lengths = np.array([len(x) for _, x in rows])
    windows = np.frombuffer(b"".join(x.ljust(WINDOW, b"\0") for _, x in rows), np.uint8).reshape(-1, WINDOW)
    return train(windows, lengths, np.array([languages.index(x) for x, _ in rows]), languages)


def predict(docs: DataFrame, model: Model | None, keep: list[str] | None = None, text_column: str = "text", block: int = 48) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all, if not given) with ``lang_pred`` and ``score``, one row for every row.

    The whole text counts, whatever its length. A text that is null, empty or has no letter is ``und`` with score 0,
    and so is every text where nothing was learned. Columns of these two names are replaced; an empty table gives an
    empty result.
    """
    keep = [x for x in (keep or docs.columns) if x not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    has_letter = F.coalesce(F.col(text_column).rlike(r"\p{L}"), F.lit(False))
    needed = [*keep, *({text_column} - set(keep))]
    flag = "has_letter"
    while flag in needed:
        flag += "_"

    def run(batches):
        model = shared.value
        names = np.array([*(model.languages if model else []), UNKNOWN], object)
        for batch in portions(batches, text_column):
            data, offsets = utf8(column_of(batch, text_column))
            starts, lengths, rows = cut_windows(data, offsets)
            sums = np.zeros((batch.num_rows, max(1, len(names) - 1)))
            for at in range(0, len(starts), block) if model else ():
                part = slice(at, at + block)
                p = probabilities(model, gather(data, starts[part], lengths[part]), lengths[part])
                np.add.at(sums, rows[part], p * lengths[part][:, None])
            best = sums.argmax(axis=1)
            known = column_of(batch, flag).to_numpy(zero_copy_only=False).astype(bool) & bool(model)
            score = np.where(known, sums[np.arange(len(best)), best] / np.maximum(np.diff(offsets), 1), 0.0)
            label = names[np.where(known, best, len(names) - 1)]
            columns = [column_of(batch, x) for x in keep] + [pa.array(label, pa.string()), pa.array(np.clip(score, 0, 1))]
            yield pa.record_batch(columns, [*keep, "lang_pred", "score"])

    schema = T.StructType([docs.schema[x] for x in keep] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.select(*needed, has_letter.alias(flag)).mapInArrow(tidy(run), schema)
